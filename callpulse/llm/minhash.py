"""Near-duplicate groups by b-bit MinHash (word shingles, exact confirmation).

1. One pass over the texts gives each document its number of distinct shingles,
   a 128-bit hash of the set, ``BANDS`` band keys over ``ROWS`` full minima each,
   and a b-bit signature: the low ``BITS`` bits of every minimum, packed as bit
   planes of 64-bit words.
2. Equal sets collapse onto their smallest doc_id; from here on only these
   representatives take part, so a group of exact copies costs one row each.
3. Documents that share a band key are candidates. A band bucket is not
   expanded into its pairs: each member is paired with the bucket's smallest
   doc_id. Pairs whose collision-corrected similarity, from bit counts over the
   signatures, is far below the threshold are passed over (``SLACK`` is more
   than five standard deviations); the others are confirmed on full sets.
4. Connected components of the confirmed links. A bucket whose members are all
   in one component can add nothing. For the members of the other buckets the
   remaining links are found by an exact prefix filter: with shingles ordered
   from rare to frequent, two sets of similarity t share one of their first
   n - ceil(t n) + 1 shingles, early enough in both that enough places follow. Only pairs from different components are made,
   so no link between candidates is lost and no group is expanded into pairs.

At a similarity of 0.8 a pair misses all bands with probability
(1 - 0.8**4)**32 = 5e-8. Similarity is compared in whole numbers
(100 * intersection >= percent * union) on sets of 64-bit shingle hashes.

Edge cases: null and wordless texts have an empty set and are linked with
nothing; fewer words than a shingle make one shingle of the whole sequence;
rows without doc_id are linked with nothing (component_id null, kept true);
rows that repeat a doc_id and text get the same result; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpulse.llm import kernels as K
from callpulse.llm.substring_dedup import _pieces
from callpulse.llm.workspace import Workspace, splittable

SHINGLE = 5
PERCENT = 80
BANDS, ROWS, BITS = 32, 4, 4
MINIMA = BANDS * ROWS
WORDS64 = MINIMA // 64
SLACK = 0.2

_r = np.random.default_rng(77)
_A = _r.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _r.integers(0, 1 << 63, MINIMA, dtype=np.uint64)


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending within the row, and the n + 1 offsets."""
    start, end, row = K.words(data, off)
    w = K.word_hashes(data, start, end, fold=True)
    first = np.searchsorted(row, np.arange(len(off)))
    count = np.diff(first)
    h = K.run_hash(w, size)
    sets, n = [], []
    for r, (lo, k) in enumerate(zip(first[:-1].tolist(), count.tolist())):
        if k >= size:
            s = np.unique(h[lo : lo + k - size + 1])
        elif k:
            s = K.span_hash(w[lo : lo + k], np.array([0]), np.array([k]), K.BASE2) ^ np.uint64(k)
        else:
            s = h[:0]
        sets.append(s)
        n.append(len(s))
    return (np.concatenate(sets) if sets else h[:0]), np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def _signature_rows(size: int):
    planes = [f"p{i}" for i in range(BITS * WORDS64)]

    def run(batches):
        for batch in batches:
            for a, b, data, off in _pieces(batch):
                u, so = shingle_sets(data, off, size)
                n = np.diff(so)
                full = np.flatnonzero(n)
                at = so[:-1][full]
                minima = np.zeros((MINIMA, b - a), np.uint64)
                s1 = np.zeros(b - a, np.uint64)
                s2 = np.zeros(b - a, np.uint64)
                if len(full):
                    for k in range(MINIMA):
                        v = u * _A[k]
                        v += _B[k]
                        minima[k, full] = np.minimum.reduceat(v, at)
                    s1[full] = np.add.reduceat(K.mix(u), at)
                    s2[full] = np.add.reduceat(K.mix(u ^ np.uint64(K.BASE)), at)
                minima = K.mix(minima)
                bands = np.zeros((BANDS, b - a), np.uint64)
                for k in range(BANDS):
                    key = np.full(b - a, k + 1, np.uint64)
                    for x in minima[k * ROWS : (k + 1) * ROWS]:
                        key = K.mix(key * np.uint64(K.BASE) + x)
                    bands[k] = key
                cols = []
                for bit in range(BITS):
                    on = (minima >> np.uint64(bit)) & np.uint64(1)
                    for w in range(WORDS64):
                        cols.append(np.bitwise_or.reduce(on[64 * w : 64 * w + 64] << np.arange(64, dtype=np.uint64)[:, None]))
                keys = pa.ListArray.from_arrays(
                    pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(bands.T.ravel().view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(n), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), keys]
                    + [pa.array(c.view(np.int64)) for c in cols],
                    ["doc", "n", "s1", "s2", "bands", *planes],
                )

    schema = "doc long, n long, s1 long, s2 long, bands array<long>, " + ", ".join(f"{p} long" for p in planes)
    return run, schema, planes


def _set_rows(size: int):
    def run(batches):
        for batch in batches:
            for a, b, data, off in _pieces(batch):
                u, so = shingle_sets(data, off, size)
                raw = u.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([raw[8 * x : 8 * y] for x, y in zip(so[:-1].tolist(), so[1:].tolist())], pa.binary()),
                    ],
                    ["doc", "items"],
                )

    return run


def _confirmed(percent: int):
    def run(batches):
        for batch in batches:
            u, v = batch.column("u"), batch.column("v")
            ok = []
            for x, y in zip(batch.column("ui"), batch.column("vi")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    ok.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([u.filter(keep), v.filter(keep)], ["u", "v"])

    return run


def estimate(planes: list[str], left: str, right: str) -> Column:
    """Similarity from the bits in which the signatures differ, corrected for chance agreement."""
    apart = F.lit(0)
    for w in range(WORDS64):
        differ = None
        for bit in range(BITS):
            p = planes[bit * WORDS64 + w]
            x = F.col(f"{left}.{p}").bitwiseXOR(F.col(f"{right}.{p}"))
            differ = x if differ is None else differ.bitwiseOR(x)
        apart = apart + F.bit_count(differ)
    chance = 2.0**-BITS
    return ((1 - apart / MINIMA) - chance) / (1 - chance)


def components(links: DataFrame, work: Workspace, label: str) -> DataFrame:
    """(doc, comp): the smallest document reachable, for every document of (u, v).

    Minimum of the neighbours' labels, then a jump to the label's own label, until
    nothing changes; the number of rounds is about the logarithm of the longest chain.
    """
    both = links.select(F.col("u").alias("doc"), F.col("v").alias("next")).union(links.select("v", "u"))
    both = work.table(both.where("doc <> next"), f"{label}-edges")
    label_now = work.table(both.groupBy("doc").agg(F.least(F.min("next"), F.first("doc")).alias("comp")), f"{label}-0")
    k = 0
    while True:
        k += 1
        near = (
            both.join(label_now.withColumnRenamed("doc", "next"), "next")
            .groupBy("doc")
            .agg(F.min("comp").alias("near"))
        )
        step = label_now.join(near, "doc").select("doc", "comp", F.least("comp", "near").alias("low"))
        jump = label_now.select(F.col("doc").alias("low"), F.col("comp").alias("far"))
        new = work.table(
            step.join(jump, "low", "left").select("doc", F.coalesce("far", "low").alias("comp"), (F.coalesce("far", "low") < F.col("comp")).alias("moved")),
            f"{label}-{k}",
        )
        done = new.where("moved").limit(1).count() == 0
        work.delete(f"{label}-{k - 1}")
        label_now = new.select("doc", "comp")
        if done:
            return label_now


def _exploded(batches):
    for batch in batches:
        items = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("items")]
        n = np.array([len(x) for x in items])
        row = pa.array(np.repeat(np.arange(len(n)), n))
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(row) for c in ("doc", "comp")] + [pa.array(np.repeat(n, n)), pa.array(np.concatenate(items) if len(n) else [], pa.int64())],
            ["doc", "comp", "n", "item"],
        )


def _prefix_pairs(docs: DataFrame, sets: DataFrame, percent: int, work: Workspace) -> DataFrame:
    """Pairs (u, v) from different components that share a shingle of their prefixes."""
    items = docs.join(sets, "doc").select("doc", "comp", "items").mapInArrow(_exploded, "doc long, comp long, n long, item long")
    items = work.table(items, "items")
    often = items.groupBy("item").agg(F.count("*").alias("often")).where("often > 1")
    rare_first = Window.partitionBy("doc").orderBy("often", "item")
    shared = items.join(splittable(often, "item"), "item").withColumn("k", F.row_number().over(rare_first)).withColumn("k_all", F.count("*").over(Window.partitionBy("doc")))
    # shingles of no other document come first and take places of the prefix
    room = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("k_all"))
    place = F.col("k") + F.col("n") - F.col("k_all")
    prefix = shared.where(F.col("k") <= room).select("doc", "comp", "item", "n", place.alias("place"))
    weight = docs.groupBy("comp").agg(F.count("*").alias("weight"))
    prefix = work.table(prefix.join(weight, "comp").select("doc", "item", "n", "place", F.struct("weight", "comp").alias("c")), "prefix")
    # of two components the lighter one asks; the heaviest of a shingle never does
    top = prefix.groupBy("item").agg(F.max("c").alias("top"))
    asks = prefix.join(splittable(top, "item"), "item").where("c < top").alias("x")
    all_of = prefix.alias("y")
    # at the first shared shingle at most the places from there on can agree
    rest = 1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    return (
        asks.join(all_of, (F.col("x.item") == F.col("y.item")) & (F.col("x.c") < F.col("y.c"))
                  & ((100 + percent) * rest >= percent * (F.col("x.n") + F.col("y.n"))))
        .select(F.least("x.doc", "y.doc").alias("u"), F.greatest("x.doc", "y.doc").alias("v"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, work: Workspace | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    work = work or Workspace(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run, schema, planes = _signature_rows(shingle)
    signed = work.table(docs.mapInArrow(run, schema), "signed")
    named = signed.where("doc is not null and n > 0")
    reps = work.table(
        named.groupBy("s1", "s2", "n").agg(F.min("doc").alias("rep")), "classes"
    )
    one = work.table(
        named.join(reps.select(F.col("rep").alias("doc")), "doc", "left_semi").dropDuplicates(["doc"]), "one"
    )
    buckets = one.select("doc", F.explode("bands").alias("key"))
    hubs = buckets.groupBy("key").agg(F.min("doc").alias("hub"), F.max("doc").alias("top")).where("hub < top").select("key", "hub")
    members = work.table(buckets.join(splittable(hubs, "key"), "key"), "members")
    light = one.select("doc", "n", *planes)

    # sets of all documents that share a bucket with another one
    some = members.select("doc").distinct()
    sets = work.table(
        docs.join(some, docs.doc_id == some.doc, "left_semi").mapInArrow(_set_rows(shingle), "doc long, items binary").dropDuplicates(["doc"]),
        "sets",
    )

    def confirm(pairs: DataFrame, label: str) -> DataFrame:
        close = (
            pairs.join(light.alias("a"), F.col("u") == F.col("a.doc"))
            .join(light.alias("b"), F.col("v") == F.col("b.doc"))
            .where(100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n"))
            .where(estimate(planes, "a", "b") >= percent / 100 - SLACK)
            .select("u", "v")
        )
        s = sets.select(F.col("doc").alias("u"), F.col("items").alias("ui"))
        t = sets.select(F.col("doc").alias("v"), F.col("items").alias("vi"))
        return work.table(close.join(t, "v").join(s, "u").select("u", "v", "ui", "vi").mapInArrow(_confirmed(percent), "u long, v long"), label)

    star = members.where("doc <> hub").select(F.col("hub").alias("u"), F.col("doc").alias("v")).distinct()
    links = confirm(star, "links")
    comp = components(links, work, "star")
    # what the hubs left apart: buckets with members of different components
    at = members.join(comp, "doc", "left").select("key", "doc", F.coalesce("comp", "doc").alias("comp"))
    open_keys = at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    left = work.table(at.join(splittable(open_keys, "key"), "key").select("doc", "comp").distinct(), "open")
    rest = _prefix_pairs(left, sets, percent, work)
    more = confirm(rest, "more")
    if more.limit(1).count():
        comp = components(links.union(more), work, "all")
    home = reps.join(comp.withColumnRenamed("doc", "rep"), "rep", "left").select("s1", "s2", "n", F.coalesce("comp", "rep").alias("component_id"))
    return (
        signed.select("doc", "n", "s1", "s2")
        .join(home, ["s1", "s2", "n"], "left")
        .select(
            F.col("doc").alias("doc_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc").isNull(), None).otherwise(F.coalesce("component_id", "doc")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
