"""Packing, spelling variants and the conversation trie against plain versions on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from callpulse.llm.conversation_trie import prefix_trie
from callpulse.llm.packing import Bins, pack_documents, padding
from callpulse.llm.queries import tokenizer_path
from callpulse.llm.spelling_variants import Acceptor, spelling_variants

# -- packing ----------------------------------------------------------------------


@lru_cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@lru_cache(maxsize=None)
def token_ids(text):
    return [*library().encode(text or "", add_special_tokens=False).ids, 0]


def check_packed(packed, rows, capacity):
    """Every id in exactly one piece, digests right, sequences without gaps and within capacity."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in packed:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    want = defaultdict(list)
    for d, t in rows:
        want[d].append(np.array(token_ids(t), "<u4"))
    assert docs.keys() == want.keys()
    for d, texts in want.items():
        assert {len(ids) for ids in texts} == {r.doc_tokens for r in docs[d]}
        for r in docs[d]:
            assert any(len(ids) == r.doc_tokens and zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for ids in texts)
        assert sum(r.length for r in docs[d]) == sum(map(len, texts)), d
        if len(texts) == 1:
            at = 0
            for r in sorted(docs[d], key=lambda r: r.start):
                assert r.start == at
                at += r.length
            assert at == len(texts[0])
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity


@pytest.mark.parametrize("capacity,whole_below", [(1024, 32), (64, 8), (64, 64), (16, 1)])
def test_packing_holds_every_id_once(docs, rows, capacity, whole_below):
    packed = pack_documents(docs, tokenizer_path(), capacity, whole_below)
    check_packed(packed.collect(), rows, capacity)
    p = padding(packed, capacity).first()
    assert p.ids == sum(len(token_ids(t)) for _, t in rows)
    if whole_below == 1:
        assert p.padded == 0


def test_bins_are_filled_by_a_fixed_count():
    bins = Bins(1024, 32, 0)
    rnd = random.Random(1)
    for i in range(4000):
        bins.add(i, bytes(4 * rnd.randint(1, 3000)))
    full = defaultdict(list)
    for _, _, length, _, _, s, _ in bins.rows:
        full[s].append(length)
    assert all(set(x) == {x[0]} and len(x) == 1024 // x[0] for x in full.values())
    assert {x[0] for x in full.values()} >= {1024, 512, 256, 128, 64, 32, 31, 20, 9}
    before = len(full)
    bins.close()
    tail = defaultdict(int)
    for _, _, length, _, _, s, _ in bins.rows:
        tail[s] += length
    assert all(n & (n - 1) == 0 for s, n in tail.items() if s >= before)  # what was left needs no padding
    assert sum(1024 - n for n in tail.values() if n & (n - 1)) < 0.005 * sum(tail.values())


def test_packing_odd_texts(spark):
    texts = [
        None, "", " ", "  ", "a", " a", "a  b", "a   b ", "x\n \ny", "x \n", "\t\tx", "a b", "a  b", "a\x1cb !\x1c?", "\x1c \x1d",
        "<|endoftext|>", "a <|endoftext|> b", "a\n <|endoftext|>\n b", "it's we'll  they're", "é" * 50, "😀 😀", "x" * 5000, "y " * 40_000, "z" * 600_000,
    ]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, length int")
    check_packed(pack_documents(df, tokenizer_path()).collect(), rows, 1024)


def test_packing_empty_table(no_docs):
    assert pack_documents(no_docs, tokenizer_path()).count() == 0
    assert padding(pack_documents(no_docs, tokenizer_path())).first() == (0, 0, 0)


# -- spelling variants ------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows):
    counts = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


@pytest.fixture(scope="module")
def spelled():
    """Texts of few letters, so that many words are near each other, with a popular word, chains of forms and long runs."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.choice([4, 5, 5, 6, 6, 7, 9]))) for _ in range(300)]
    words += ["popular" + c for c in "abcdeÀÁ×÷"] + ["opular", "populr", "xpopular", "popular"] * 2
    weights = [rnd.choice([1, 2, 4, 8, 16]) for _ in words]
    rows = [(i, " ".join(rnd.choices(words, weights, k=90))) for i in range(60)]
    rows += [(100 + i, "POPULAR Popular popularly, populär! " * 9 + "don't " * 3) for i in range(12)]
    long = "".join(rnd.choice("ab") for _ in range(9_000))
    rows += [(200, f"{long} {long} {long}"), (201, f"{long[:4000]}x{long[4000:]} " * 3), (202, f"{long[:8990]}y{long[8991:]} " * 7), (203, "é" * 400 + " ")] * 2
    rows += [(None, "without name " * 5), (300, None), (301, ""), (302, "12 34 __ Āā"), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("limit", [4096, 3])
def test_variants_equal_brute_force(spark, spelled, limit):
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in spelled], "doc_id long, text string, word string, n int").repartition(4)
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling_variants(df, limit=limit).collect()}
    want = plain_variants(spelled)
    assert len(want) > 200 and any(form and want[form][0] for form, *_ in want.values())
    assert got == want


def test_variants_empty(no_docs):
    assert spelling_variants(no_docs).count() == 0


def test_acceptor_is_minimal_and_composes():
    rnd = random.Random(8)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.choice([4, 5]))) for _ in range(150)})
    acceptor = Acceptor()
    start = acceptor.add(words, 0, len(words))
    assert sorted(acceptor.right(start)) == words
    ends = {w[k:] for w in words for k in range(len(w) + 1)}
    languages = {tuple(sorted(x[len(p) :] for x in words if x.startswith(p))) for w in words for p in [w[:k] for k in range(len(w) + 1)]}
    assert len(acceptor.arcs) == len(languages) and ends
    pairs = [frozenset((b + c + w, b + d + w)) for b, c, d, rest in acceptor.pairs(start, 99) for w in rest]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {frozenset((x, y)) for x in words for y in words if x < y and one_edit(x, y)}


# -- conversation trie ------------------------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted(
        (r for r in rows if r[0] is not None),
        key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", hashlib.md5(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).digest()),
    ):
        own[c].append((role or "", text or ""))
    conv = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - c % 5 if c >= 0 else c + (-c) % 5
        conv[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c in sorted(conv):
        for d in range(len(conv[c]) + 1):
            members[tuple(conv[c][:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = {}
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = ",".join(str(c) for c in cs if len(conv[c]) == len(p))
        out[cs[0], len(p)] = (
            members[p[:-1]][0] if p else None, len(cs), kids[p], sum(not kids[q] for q in below),
            sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest(),
        )
    assert len(out) == len(members)
    return out


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(4)
    turns = ["hello", "hé", "", None, "again", "x" * 3000]
    roles = ["user", "assistant", None]
    rows = []
    for c in [*range(0, 70), 1000, 1003, 2**40, -1, -3, -7]:
        for t in range(rnd.choice([0, 1, 1, 2, 3, 5])):
            rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(roles), rnd.choice(turns)))
    for c in range(100, 140):  # a third of all: one conversation, and one first turn
        rows += [(c, 0, "user", "same"), (c, 1, "assistant", "answer"), (c, 2, "user", f"{c % 3}")]
    rows += [(200 + c, t, "user", f"deep {t}") for c in (0, 5) for t in range(700)]  # deeper than the recursion limit allows
    rows += [rows[3], rows[3], (None, 0, "user", "no one"), (77, None, None, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_rows", [16_384, 40])
def test_trie_equals_brute_force(spark, talks, shard_rows):
    schema = "conv_id long, turn long, role string, text string, path string, depth int"
    df = spark.createDataFrame([(*r, "p", 1) for r in talks], schema).repartition(6)
    got = prefix_trie(df, shard_rows).collect()
    assert {(r.conv_id, r.depth): tuple(r)[2:] for r in got} == plain_trie(talks)
    assert len(got) == len({(r.conv_id, r.depth) for r in got})


def test_trie_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie(df).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], df.schema)).count() == 0
