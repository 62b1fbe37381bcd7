"""Language ID, HTML, tokens, fingerprints, decontamination, licences and the pipeline on small tables."""

import html
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from callpulse.llm import fingerprints as FP
from callpulse.llm import language_id as L
from callpulse.llm.bpe import Tokenizer, decode_ids, encode_texts
from callpulse.llm.decontaminate import leaks
from callpulse.llm.html_extract import extract, main_texts, parse
from callpulse.llm.license_scan import license_matches
from callpulse.llm.queries import tokenizer_path
from callpulse.llm.token_counts import context_totals, length_histogram, lengths_at, totals_at

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer as T

    t = T.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = L.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (r.lang == r.lang_pred).mean() > 0.98
    assert r.score.between(0, 1).all()


def test_language_edges(docs, rows, no_docs, spark):
    got = L.identify_languages(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    by = {r.doc_id: r for r in got}
    for i in (70, 71, 72, 73):
        assert (by[i].lang_pred, by[i].score) == ("und", 0)
    assert by[78].lang_pred in ("aa", "bb")
    assert L.identify_languages(no_docs).count() == 0
    untrained = L.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in untrained} == {"und"}


def test_html_on_given_pages(spark):
    import re

    def plain(h):
        inner = re.search(r"<article[^>]*>(.*)</article>", h, re.S)[1]
        parts = [re.sub(r"<br>|</?b>", " ", x) for x in re.split(r"</?(?:h1|p)>", inner)]
        return "\n\n".join(y for y in (" ".join(html.unescape(x).split()) for x in parts) if y)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in main_texts(pages).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_html_edges(spark):
    long = "<article><p>" + "word " * 50_000 + "</p></article>"
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>a<p>b"), (4, "u", long), (4, "u", long), (None, "u", "<article><p>x &lt; y</p><script>no()</script>")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = main_texts(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r.text for r in got}
    assert by[1] == by[2] == "" and by[4] == ("word " * 50_000).strip() and by[None] == "x < y"
    assert main_texts(pages.where("false")).count() == 0
    assert extract(["plain<nav>x</nav>"], None) == ["plain"] and extract(["<main>a<br>b&nbsp;c</main><nav>d</nav>"], None) == ["a b c"]
    assert parse("<div><p>a</div></p></x><").tag[0] == "html"


def test_html_text_around_and_in_embedded_elements():
    body = "<article><p>a</p><p>b</p></article>"
    closed = ["<svg/>", "<svg viewBox='0 0 1 1' />", "<math/>", "<svg><title>t</title><g><text>x</text></g></svg>", "<svg><style/><title/></svg>"]
    closed += ["<select><option>x<option>y</select>", "<select><option><div>x</div></option></select>", "<template><p>x</p></template>", "<textarea><p>x</textarea>"]
    closed += ["<script>'<p>x'</script>", "<style>p>a{}</style>", "<iframe><p>x</iframe>", "<noscript><p>x</noscript>", "<svg><svg>x</svg>y</svg>"]
    unclosed = ["<svg>", "<svg><path d='1'>", "<select>", "<select><option>x", "<template>", "<object data=1>", "<math>"]
    for x in closed + unclosed:
        for page in (x + body, x + body + "<svg><text>z</text></svg><select><option>z</select><template>z</template>", "<head>" + x + "<body>" + body):
            assert extract([page], None) == ["a\n\nb"], page
    for x in closed:
        assert extract([f"<article><p>a</p>{x}<p>b</p></article>"], None) == ["a\n\nb"], x
    assert extract(["<main>let <math><mi>x</mi><mo>=</mo><mn>2</mn><mspace/></math> be</main>"], None) == ["let x=2 be"]
    assert extract(["<main>let <math><semantics><mi>x</mi><annotation>\\\\x</annotation></semantics></math> be</main>"], None) == ["let x be"]
    assert extract(["<main>see <object data=x><param name=y>the fallback</object> here</main>"], None) == ["see the fallback here"]


def test_html_trees_decide_at_every_size():
    from callpulse.llm.html_extract import train

    page = "<article><h1>A title</h1><p>One sentence of text.</p><p>And one more of it.</p></article>"
    for pages in ([], [page], ["<p>no main element</p>"] * 5):
        model = train(pages)
        assert model is not None
        got = extract([page + "<nav><ul><li><a>x</a></li><li><a>y</a></li></ul></nav>", "<p>a<p>b", "plain"], model)
        assert got == ["A title\n\nOne sentence of text.\n\nAnd one more of it.", "a\n\nb", "plain"]


def test_html_decoding_has_no_kept_node_below_a_dropped_one():
    import numpy as np

    from callpulse.llm.html_extract import Forest

    page = "<div><ul><li>a</li><li>b<p>c</p></li></ul><div>d</div></div>" * 4
    f = Forest([parse(page), parse("<p>x")])
    rnd = np.random.default_rng(1)
    for _ in range(20):
        keep = f.decode(rnd.normal(size=len(f.parent)) * 3)
        assert (keep <= keep[f.parent]).all()


def test_encoding_matches_the_library(library):
    mine = Tokenizer(tokenizer_path())
    rnd = random.Random(2)
    pool = ["the", " ", "  ", "\n", "é", "日本", "🎉", "\x1c", "\x85", "\xa0", "'s", "'S", "12", "²", "_", "<|endoftext|>", "<|end", "a" * 70, "x" * 300, "\x00", "́"]
    for _ in range(600):
        s = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12)))
        ids = library.encode(s, add_special_tokens=False).ids
        assert mine.encode(s) == ids, s
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)
    some = [rnd.randrange(50257) for _ in range(500)]
    assert mine.decode(some) == library.decode(some, skip_special_tokens=False)


def test_encoding_of_tables(docs, rows, no_docs, library):
    want = {(i, t or ""): library.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    got = encode_texts(docs, tokenizer_path())
    plain = Counter((i, tuple(x)) for (i, _), x in ((k, want[k]) for k in ((i, t or "") for i, t in rows)))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == plain
    for r in got.collect():
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == brute.sha(",".join(map(str, r.ids)))
    back = {r.doc_id: r.text for r in decode_ids(got.where("doc_id is not null"), tokenizer_path()).collect()}
    assert all(back[i] == (t or "") for i, t in rows if i is not None)
    assert encode_texts(no_docs, tokenizer_path()).count() == 0


def test_token_totals(docs, rows, no_docs, library):
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    got = {r.context_limit: r for r in context_totals(length_histogram(docs, tokenizer_path())).collect()}
    assert set(got) == set(n)
    for k, r in got.items():
        assert r.n_docs == n.count(k)
        assert r.docs_longer == sum(x > k for x in n)
        assert r.tokens_truncated == sum(min(x, k) for x in n)
        assert r.tokens_total == sum(n)
        assert r.quantile == pytest.approx(sum(x <= k for x in n) / len(n))
    assert context_totals(length_histogram(no_docs, tokenizer_path())).count() == 0


def test_neighbour_edits(docs, rows, no_docs, spark):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = Counter()
    for k, (i, t) in enumerate(ordered):
        # the next document is the next row of the order; a repeated row is its own row
        nxt = ordered[(k + 1) % len(ordered)][1]
        cut = len(t) // 3
        want[i, len(t), brute.sha(t[: len(t) - cut] + nxt[:cut])] += 1
    for buckets in (1, 4):
        got = FP.neighbour_edits(docs, buckets).collect()
        assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert FP.neighbour_edits(no_docs).count() == 0
    one = FP.neighbour_edits(spark.createDataFrame([(1, "abc def")], "doc_id long, text string")).collect()[0]
    assert one.near_next == 1.0 and one.edited_sha256 == brute.sha("abc dab")


def test_fingerprints(docs, rows):
    got = FP.fingerprints(docs).collect()
    by_text = {}
    texts = {i: t or "" for i, t in rows if i is not None}
    for r in got:
        if r.doc_id is not None:
            assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert by_text[""] == ""
    assert len(set(by_text.values())) == len(by_text) - 1  # the two periodic texts have the same syncmers
    a, b = ("some words that go on " * 3 + str(k) * 40 for k in (1, 2))
    s, t = FP.sketches(*FP._laid_out([a, b]))
    assert FP.likeness(s, s) == 1.0 and 0 < FP.likeness(s, t) < 1
    assert FP.text_of(FP.sketch_of(FP.text_of(s))) == FP.text_of(s)


def test_syncmers_do_not_depend_on_context():
    passage = "a passage of some length that is found again elsewhere, word by word"
    texts = ["x" * 31 + passage, "other start " + passage + " and end"]
    data, off = FP._laid_out(texts)
    at, row, h = FP.syncmers(data, off)
    inner = []
    for r, t in enumerate(texts):
        lo = t.encode().index(passage.encode())
        inner.append({(a - off[r] - lo, x) for a, x in zip(at[row == r], h[row == r]) if lo <= a - off[r] <= lo + len(passage) - FP.KMER})
    assert inner[0] == inner[1] and inner[0]


def test_leaks(docs, rows, no_docs, spark):
    texts = {i: t for i, t in rows if t}
    items = [(1, " ".join(texts[12].split()[:20])), (1, " ".join(texts[12].split()[:20])), (2, None), (3, ""), (4, "one two three"),
             (5, " ".join(texts[61].split()[30:60]).upper()), (6, "not in any of the documents at all"), (7, texts[13] + " tail")]
    table = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, h string")
    got = {(r.doc_id, r.item_id): r.similarity for r in leaks(docs, table).collect()}
    want = brute.leaks(rows, items)
    assert set(got) == set(want) and len(want) > 4
    assert all(got[k] == pytest.approx(v) for k, v in want.items())
    assert leaks(no_docs, table).count() == 0
    assert leaks(docs, table.where("false")).count() == 0


def test_leaks_with_repeated_words(spark):
    """One shingle that is counted often and differs between the text and the item moves the counts' cosine far below that of sets."""
    rnd = random.Random(4)
    rows, items = [], []
    for k in range(30):
        w = [f"w{rnd.randrange(10**6)}" for _ in range(380)]
        items.append((k, " ".join([*w, *["_"] * 46])))
        rows.append((100 + k, " ".join([*w, *["-"] * 46])))
        v = [f"v{rnd.randrange(10**6)}" for _ in range(200)]
        items.append((50 + k, " ".join([*v[:100], *["_"] * 20, *v[100:]])))
        rows.append((200 + k, " ".join(["x", *v[:100], *["|"] * 20, *v[100:], "y"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute.leaks(rows, items)
    assert len(want) >= 30 and got == pytest.approx(want)


def test_licences(spark, no_docs):
    mit = "Permission is hereby granted, free of charge, to any person"
    rows = [
        (1, "Text before.\nReleased under the MIT License.\nafter"), (2, "All rights reserved"), (3, None), (4, ""),
        (5, "released UNDER the -- MIT license, twice: Released under the MIT License!"), (6, "rights are all reserved for us"),
        (7, "x " * 30_000 + "Licensed under CC BY-NC 4.0."), (8, mit), (2, "All rights reserved"), (None, "All rights reserved."),
    ]
    got = license_matches(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, h int")).collect()
    n = Counter((r.doc_id, r.license) for r in got)
    assert n == {(1, "mit-line"): 1, (2, "all-rights-reserved"): 2, (5, "mit-line"): 2, (7, "cc-by-nc-4.0-line"): 1, (None, "all-rights-reserved"): 1}
    for r in got:
        if r.doc_id == 1:
            assert rows[0][1].encode()[r.start_byte : r.end_byte] == b"Released under the MIT License"
    half = license_matches(spark.createDataFrame([(8, "Released under the MIT Licence")], "doc_id long, text string"), coverage=0.8).collect()
    assert [r.coverage for r in half] == [0.8]
    assert license_matches(no_docs).count() == 0 and license_matches(spark.createDataFrame(rows, "doc_id long, text string"), {}).count() == 0


def test_totals_and_quantiles_for_any_limit(spark):
    rnd = random.Random(6)
    lengths = [rnd.choice([0, 1, 5, 255, 256, 257, rnd.randint(0, 9000)]) for _ in range(400)]
    h = spark.createDataFrame(list(Counter(lengths).items()), "length long, n_docs long").repartition(3)
    limits = [0, 1, 2, 255, 256, 300, 2048, 9_001, 100_000, 2048, None, -5]
    got = totals_at(h, spark.createDataFrame([(x,) for x in limits], "limit long")).collect()
    assert sorted(r.context_limit for r in got) == sorted({x for x in limits if x is not None and x >= 0})
    for r in got:
        x = r.context_limit
        assert r.tokens_truncated == sum(min(n, x) for n in lengths) and r.tokens_total == sum(lengths)
        assert r.docs_up_to == sum(n <= x for n in lengths) and r.docs_longer == sum(n > x for n in lengths)
    shares = [0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0, None, 2.0]
    found = {r.share: r.length for r in lengths_at(h, spark.createDataFrame([(x,) for x in shares], "share double")).collect()}
    want = {x: min(n for n in lengths if sum(m <= n for m in lengths) >= max(1, x * len(lengths))) for x in shares if x is not None and x <= 1}
    assert found == want
    empty = h.where("length < 0")
    assert totals_at(empty, spark.createDataFrame([(5,)], "limit long")).count() == 0
    assert lengths_at(empty, spark.createDataFrame([(0.5,)], "share double")).count() == 0


def test_leaks_of_long_items_stems_and_repeats(spark):
    """Shared stems, a long item inside a longer text, repeated words, items longer than the text: against the plain version."""
    rnd = random.Random(12)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    stem = "which of the following answers is the best one to choose here"
    items = [(i, f"{stem} {prose(rnd.randint(1, 12))}") for i in range(25)] + [(100, prose(160)), (101, "one two three four"), (102, prose(20) + " na" * 30), (103, stem)]
    docs = [(i, f"{prose(10)} {t} {prose(15)}") for i, t in items[::3]]
    docs += [(200, f"{prose(50)} {items[25][1]} {prose(200)}"), (201, " ".join(items[25][1].split()[:140])), (202, f"{stem} and nothing else"), (203, (stem + " ") * 8)]
    docs += [(204, prose(10) + " " + items[27][1].replace(" na", " na na", 2)), (205, "One TWO three four"), (206, "one two three"), (207, None)]
    w = items[25][1].split()
    w[70:74] = ["x"]
    docs.append((208, f"{prose(30)} {' '.join(w)} {prose(30)}"))
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute.leaks([d for d in docs if d[1]], items)
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(want) >= 15


def test_licences_with_edits(spark):
    """Notices with words changed, left out or put in, against alignment on every diagonal."""
    import re

    from callpulse.llm.license_templates import TEMPLATES

    def best(template, text):
        a, b = (re.findall("[a-z0-9]+", x.lower()) for x in (template, text))
        band, most = max(2, len(a) // 5), 0
        for d in range(-len(a), len(b) + 1):
            row = [0] * (len(b) + 1)
            for i, x in enumerate(a):
                new = row[:]
                for j, y in enumerate(b):
                    new[j + 1] = max(new[j], row[j + 1], row[j] + 1 if x == y and abs(j - i - d) <= band else 0)
                row = new
            most = max(most, row[-1])
        return most, len(a)

    rnd = random.Random(9)
    short = {k: v for k, v in TEMPLATES.items() if len(v.split()) < 15}
    texts = ["Released under an MIT License", "Released below the MIT License", "Licensed under the CC BY-NC-SA 4.0", "the " * 3000]
    for v in short.values():
        for _ in range(6):
            w = v.split()
            for _ in range(rnd.randint(1, 3)):
                k = rnd.randrange(len(w))
                w[k : k + rnd.randint(0, 1)] = rnd.choice([["x"], [], ["the"], ["y", "z"]])
            texts.append("some text " + " ".join(w) + " and more")
    texts += [texts[5] + " " + texts[6], "a " * 20 + TEMPLATES["bsd"].replace("and", "or").replace("source", "code")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in license_matches(docs, {**short, "bsd": TEMPLATES["bsd"]}).collect():
        got[r.doc_id, r.license] = max(r.coverage, got.get((r.doc_id, r.license), 0))
    want = {}
    for i, t in enumerate(texts):
        for name in [*short, "bsd"] if len(t) < 1000 else ():
            n, m = best(TEMPLATES[name], t)
            if n >= 0.8 * m:
                want[i, name] = n / m
    assert got == pytest.approx(want)
    assert got[0, "mit-line"] == got[1, "mit-line"] == 0.8 and got[2, "cc-by-nc-4.0-line"] == 1.0


def test_licences_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {"gpl-3.0-line": "GNU General Public License, version 3.", "mit-line": "Released under the MIT License.", "all-rights-reserved": "All rights reserved."}
    got = license_matches(docs).groupBy("license").agg(F.countDistinct("doc_id").alias("n")).collect()
    for r in got:
        if r.license in lines:
            assert r.n == docs.where(F.contains("text", F.lit(lines[r.license]))).count()


def test_pipeline_against_plain_version(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pred = {r.doc_id: r.lang_pred for r in L.predict(docs.select("doc_id", "text"), L.train(docs)).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if pred[r.doc_id] != "und"]
    group = brute.near_groups(rows, 5)
    rows = [(i, t) for i, t in rows if group[i][1] == i]
    cut = brute.repeated_bytes(rows)
    rows = [(i, cut[i][4].decode("utf-8", "ignore")) for i, _ in rows]
    bad = {d for d, _ in brute.leaks(rows, [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])}
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in rows if i not in bad}
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_columns_and_handle_edges(spark, docs, no_docs, tmp_path):
    spark.createDataFrame([(1, "a benchmark text of a few words here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, start in enumerate((docs, no_docs)):
        at = start
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, str(tmp_path))
            out.write.parquet(f"{tmp_path}/{k}-{name}")
            if name != "bpe":
                assert out.columns == start.columns
            at = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        assert (at.count() > 0) == (k == 0)


def test_language_stage_with_clashing_names_and_without_labels(spark, docs):
    clash = docs.withColumn("Score", F.lit("s")).withColumn("lang_pred", F.lit("p")).withColumn("__text0", F.lit("t")).withColumn("__lang0", F.lit(1))
    out = corpus_pipeline.language_id(spark, clash, SF)
    want = corpus_pipeline.language_id(spark, docs, SF)
    assert out.columns == clash.columns
    assert Counter(map(tuple, out.select(*docs.columns).collect())) == Counter(map(tuple, want.collect()))
    assert {(r.Score, r.lang_pred, r["__text0"], r["__lang0"]) for r in out.collect()} == {("s", "p", "t", 1)}
    untrained = corpus_pipeline.language_id(spark, docs.withColumn("lang", F.lit(None).cast("string")), SF).collect()
    lettered = [r for r in docs.collect() if any(c.isalpha() for c in r.text or "")]
    assert Counter((r.doc_id, r.text) for r in untrained) == Counter((r.doc_id, r.text) for r in lettered)
    assert {r.lang for r in untrained} == {None}
