import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, doc string, runs int, n string"


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): random prose with copies, near copies, shared passages, runs, nulls and a very long text."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeéxyzAB") for _ in range(rnd.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = prose(70)
    out = [(i, prose(rnd.randint(1, 160))) for i in range(40)]
    out += [(40 + i, out[i][1]) for i in range(8)]  # exact copies
    for i in range(8):  # near copies
        w = out[10 + i][1].split(" ")
        w[len(w) // 2] = word()
        out.append((50 + i, " ".join(w)))
    out += [(60 + i, prose(30) + "\n" + shared + "\t" + prose(20)) for i in range(8)]
    out += [(70, None), (71, ""), (72, "   \n"), (73, "!!! 123 ..."), (74, "ab " * 400), (75, "x" * 900), (76, "x" * 700 + shared)]
    out += [(77, prose(6000)), (78, "one two three"), (79, "One  two\nthree"), (80, "😀é" * 200), (81, "😀é" * 150)]
    out += [out[12], out[61], (None, shared), (None, None)]  # repeated rows, rows without id
    rnd.shuffle(out)
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows as documents, with extra columns whose names the operators use inside."""
    lang = lambda i: None if i is None or i % 5 == 0 else ("aa", "bb")[i % 2]
    full = [(i, t, lang(i), "s0", None if t is None else len(t), i, "d", 1, "n") for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
