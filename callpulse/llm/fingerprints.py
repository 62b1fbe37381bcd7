"""Document fingerprints from closed syncmers.

A k-mer of the UTF-8 bytes is a closed syncmer if the smallest of its inner
s-mers (a hash order) is its first or its last. Whether it is one depends on
the k-mer alone, so equal passages carry equal anchors at equal distances,
whatever surrounds them. ``anchors`` gives them with their places. The
fingerprint of a document is the ``KEPT`` smallest distinct hashes of its
syncmers in the order of their first places, as hexadecimal text. The likeness
of two fingerprints matches anchors by position: of the smallest ``KEPT`` hashes
of their union, the share that both have in the same order (the longest
increasing run of matches). So it estimates the Jaccard similarity of the two
syncmer sets, less what stands in another order.

``neighbour_edits`` compares each document with an edited text (its last third
replaced by the start of the next document, in descending doc_id) and with
the next document. Documents are ranged into buckets at approximate quantiles
of doc_id, as many as the table has ``BUCKET_BYTES`` of text; each bucket is a
task of its own, sorted and streamed, and gets a copy of the first row of the
bucket that follows, so one shuffle of the texts is enough and no task holds
more than a batch and one row.

Edge cases: null text is empty and has the empty fingerprint; a text without a
syncmer has one hash, of the whole text; two empty fingerprints have likeness 1,
an empty and another one 0; a hash that a text repeats counts once, at its first
place, so a period repeated more often is alike; rows without doc_id come last in the order;
rows with equal doc_id are ordered by text; a single document is its own next;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.llm import kernels as K

KMER, SMER = 16, 8
KEPT = 64
#: bytes of text a bucket has on average
BUCKET_BYTES = 64 << 20
#: bound of the quantile sketch, of the cuts and of the heads in driver and tasks, one number a bucket each; above 4 TB buckets grow instead
BUCKETS = 1 << 16


def syncmers(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte places, rows and 32-bit hashes of the closed syncmers of all rows."""
    values = K.BYTE[data]
    inner = K.run_hash(values, SMER)
    n = len(data) - KMER + 1
    if n <= 0:
        e = np.empty(0, np.int64)
        return e, e, np.empty(0, np.uint32)
    w = KMER - SMER + 1
    low, span = inner, 1
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < w:
        low = np.minimum(low[: len(low) - (w - span)], low[w - span :])
    closed = (low == inner[:n]) | (low == inner[w - 1 : w - 1 + n])
    at = np.flatnonzero(closed)
    row = np.searchsorted(off, at, "right") - 1
    inside = at + KMER <= off[row + 1]
    at, row = at[inside], row[inside]
    return at, row, (K.run_hash(values, KMER, K.BASE)[at] >> np.uint64(32)).astype(np.uint32)


def _smallest(h: np.ndarray) -> np.ndarray:
    """The KEPT smallest distinct values of h, in the order of their first places."""
    value, first = np.unique(h, return_index=True)
    return value[:KEPT][np.argsort(first[:KEPT])]


def sketches(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The KEPT smallest distinct hashes of each row, in the order of their first places."""
    _, row, h = syncmers(data, off)
    first = np.searchsorted(row, np.arange(len(off)))
    whole = None
    out = []
    for r in range(len(off) - 1):
        mine = h[first[r] : first[r + 1]]
        if len(mine) > 4 * KEPT:  # the smallest ones first, then distinct; all of them if repeats leave too few
            some = _smallest(mine[mine <= np.partition(mine, 3 * KEPT)[3 * KEPT]])
            mine = some if len(some) == KEPT else _smallest(mine)
        elif len(mine):
            mine = _smallest(mine)
        elif off[r + 1] > off[r]:
            if whole is None:
                whole = K.span_hash(K.BYTE[data], off[:-1], off[1:], K.BASE) >> np.uint64(32)
            mine = whole[r : r + 1]
        out.append(mine.astype(np.uint32))
    return out


def text_of(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def sketch_of(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    union = len(both) - int(twice.sum())
    size = min(KEPT, union)
    # rank of each repeated value among the distinct ones
    rank = np.cumsum(np.append(True, ~twice))[1:][twice]
    shared = both[1:][twice][rank <= size]
    order_a, order_b = np.argsort(a), np.argsort(b)
    place_a = order_a[np.searchsorted(a, shared, sorter=order_a)]
    place_b = order_b[np.searchsorted(b, shared, sorter=order_b)]
    return _in_order(place_b[np.argsort(place_a)]) / size


def _in_order(places: np.ndarray) -> int:
    """Length of the longest increasing subsequence of distinct places."""
    if (places[1:] > places[:-1]).all():
        return len(places)
    ends: list[int] = []  # smallest end of an increasing subsequence of each length
    for p in places.tolist():
        k = bisect_left(ends, p)
        ends[k : k + 1] = [p]
    return len(ends)


def _laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def anchors(docs: DataFrame) -> DataFrame:
    """doc_id, place (byte), hash of every closed syncmer."""

    def run(batches):
        for batch in batches:
            data, off = K.utf8(batch.column("text"))
            for a, b in K.pieces(off):
                at, row, h = syncmers(data[off[a] : off[b]], off[a : b + 1] - off[a])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a).take(pa.array(row)), pa.array(at - (off[a:b] - off[a])[row]), pa.array(h.astype(np.int64))],
                    ["doc_id", "place", "hash"],
                )

    return _texts(docs).mapInArrow(run, "doc_id long, place long, hash long")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every document."""

    def run(batches):
        for batch in batches:
            data, off = K.utf8(batch.column("text"))
            for a, b in K.pieces(off):
                s = sketches(data[off[a] : off[b]], off[a : b + 1] - off[a])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(map(text_of, s), pa.string())], ["doc_id", "fingerprint"])

    return _texts(docs).mapInArrow(run, "doc_id long, fingerprint string")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _with_bucket(docs: DataFrame, bounds: list[int]) -> DataFrame:
    """``bucket``: number of bounds that are at most doc_id, by bisection; rows without doc_id are below all."""
    splits = sorted({float(x) for x in bounds})
    if not splits:
        return docs.withColumn("bucket", F.lit(0))
    inf = float("inf")
    known = docs.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(-inf)))
    return Bucketizer(splits=[-inf, *splits, inf], inputCol="place", outputCol="bucket").transform(known).withColumn("bucket", F.col("bucket").cast("int")).drop("place")


def _compare(batches):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "ghost", "doc_id", "text")))

    def settle(held):
        """Rows in order; each but the last has its next at the following place if that is of the same bucket."""
        use = [i for i in range(len(held) - 1) if not held[i][1] and held[i][0] == held[i + 1][0]]
        if not use:
            return None
        texts = [r[3] for r in held]
        own = sketches(*_laid_out(texts))
        edited = []
        for i in use:
            k = len(texts[i]) // 3
            edited.append(texts[i][: len(texts[i]) - k] + texts[i + 1][:k])
        other = sketches(*_laid_out(edited))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([held[i][2] for i in use], pa.int64()),
                pa.array([len(texts[i]) for i in use], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited], pa.string()),
                pa.array([text_of(own[i]) for i in use], pa.string()),
                pa.array([text_of(s) for s in other], pa.string()),
                pa.array([likeness(own[i], s) for i, s in zip(use, other)], pa.float64()),
                pa.array([likeness(own[i], own[i + 1]) for i in use], pa.float64()),
            ],
            names,
        )

    held, size = [], 0
    for r in rows():
        if r[1] and held and held[-1][1] and held[-1][0] == r[0]:
            continue  # further rows of the doc_id that follows
        held.append(r)
        size += len(r[3])
        if size >= K.PIECE and len(held) > 1:
            if (out := settle(held)) is not None:
                yield out
            held = held[-1:]
            size = len(held[0][3])
    if (out := settle(held)) is not None:
        yield out


def neighbour_edits(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    docs = _texts(docs)
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    n = min(BUCKETS, buckets)
    cuts = docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n)).head()[0] if n > 1 else []
    placed = _with_bucket(docs, cuts or [])
    heads = placed.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()  # one row per bucket
    heads = sorted(((r["bucket"], r["head"]) for r in heads), reverse=True)
    after = [(heads[(i + 1) % len(heads)][1], b) for i, (b, _) in enumerate(heads)]
    # one row a bucket, BUCKETS at most
    ghosts = F.broadcast(spark.createDataFrame(after, "head long, ghost int"))
    placed = placed.join(ghosts, placed["doc_id"].eqNullSafe(ghosts["head"]), "left").drop("head")
    # each row once, and the rows of a head once more for the bucket before
    both = placed.select(
        "doc_id",
        "text",
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.col("bucket").cast("int").alias("bucket"), F.lit(False).alias("ghost")),
                    F.struct(F.col("ghost").alias("bucket"), F.lit(True).alias("ghost")),
                ),
                lambda x: x["bucket"].isNotNull(),
            )
        ).alias("at"),
    ).select("doc_id", "text", "at.bucket", "at.ghost")
    ordered = both.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "ghost", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.mapInArrow(
        _compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
