"""Benchmark decontamination in DataFrame operations only.

A window of a document has as many words as a benchmark item (or is the whole
document, if that is shorter). A document leaks an item if one of its windows
has a weighted shingle similarity (sum of smaller over sum of larger counts) of
``SIMILARITY`` or more with it; shingles are five words, lower-cased.

1. The shingles of all documents are tested against a bitmap of the
   benchmark's shingles (``BITMAP`` bits, whatever the size of the benchmark)
   and joined with the rarest shingles of each item, as many as a similar window cannot all
   miss: these are the pairs of document and item. A running sum over the places
   where the document has shingles of the item gives the windows that hold enough of them for the
   similarity; those windows go on, with their item.
2. Each of these windows gets a 64-bit SimHash of its shingles, each hashed
   with its running number among its equals (1 to its count). The weighted
   similarity is then that of two sets, however often a shingle is repeated.
   Multi-index search: a fingerprint within ``RADIUS`` = 23 of an item's differs
   from it by at most 2 bits in one of its 8 blocks, so the item side lists the
   37 values within 2 bits of each block and equal blocks of a window and its items are joined. Every
   fingerprint within the radius is found; the distance is then checked. Sets
   of similarity 0.8 have a cosine of 0.89 or more, 10 differing bits expected; by simulation the radius loses 4 in 10,000
   windows at the threshold for items of 5 shingles against texts of 4, under 2 in 100,000 otherwise.
3. Candidates are confirmed by the exact weighted similarity.

Nothing of the documents is broadcast by hint; the benchmark joins are left to
Spark's measured sizes.

Edge cases: a null or wordless text leaks nothing, a null or wordless item is
ignored; an item or text of fewer than five words is one shingle of its whole
sequence; rows that repeat a doc_id and text are one document, rows that repeat
an item are one item; rows without doc_id are passed over; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpulse.llm.workspace import Workspace

SHINGLE = 5
SIMILARITY = 0.8
BITMAP = 1 << 20
RADIUS = 23
BLOCKS = 8
#: for comparisons of whole numbers with multiples of the similarity
EPSILON = 1e-9


def words(text: Column) -> Column:
    """Lower-cased runs of characters other than space and 0x09 to 0x0D."""
    t = F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "[\\x20\\x09-\\x0D]+"))


def _hash(ws: Column, at: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(ws, at + k) for k in range(size)])


def _places(df: DataFrame, size: int) -> DataFrame:
    """(…, at, h): every shingle of ``size`` words of column ws."""
    long = df.where(F.size("ws") >= size)
    return long.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("ws") - size))).withColumn("h", _hash(F.col("ws"), F.col("at"), size))


def _by_size(df: DataFrame, sizes: list[int], size: Column) -> DataFrame:
    """Shingles of each row in its own shingle size."""
    out = None
    for k in sizes:
        part = _places(df.where(size == k), k)
        out = part if out is None else out.unionByName(part)
    return out


def _numbered(df: DataFrame) -> DataFrame:
    """One row for each of the c places of a shingle, x the hash of the shingle and its running number."""
    return df.withColumn("x", F.explode(F.sequence(F.lit(1), F.col("c")))).withColumn("x", F.xxhash64("h", "x"))


def _simhash() -> list[Column]:
    return [F.sum(F.shiftright("x", b).bitwiseAND(F.lit(1)) * 2 - 1).alias(f"b{b}") for b in range(64)]


def _packed() -> Column:
    out = F.lit(0).cast("long")
    for b in range(64):
        out = out.bitwiseOR(F.when(F.col(f"b{b}") > 0, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    return out


def _block(sim: str, j: int) -> Column:
    return F.shiftright(sim, 8 * j).bitwiseAND(F.lit(255).cast("long")).cast("int")


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, work: Workspace | None = None) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, start_word, n_words, similarity of its best window."""
    spark = docs.sparkSession
    work = work or Workspace(spark, "decontaminate")
    items = work.table(
        benchmark.select("item_id", words(F.col("text")).alias("ws"))
        .where(F.size("ws") > 0)
        .dropDuplicates()
        .select(F.xxhash64("item_id", "ws").alias("item"), "item_id", "ws", F.size("ws").alias("m"), F.least(F.size("ws"), F.lit(SHINGLE)).alias("k")),
        "items",
    )
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most SHINGLE values
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = texts.select("doc_id", words(F.col("text")).alias("ws"))
    empty = "doc_id long, item_id long, start_word int, n_words int, similarity double"
    if not sizes:
        return spark.createDataFrame([], empty)
    marks = work.table(_by_size(items, sizes, F.col("k")).groupBy("item", "item_id", "m", "k", "h").agg(F.count("*").cast("int").alias("c")), "marks")

    # 1. shingles of the documents that the benchmark has, through a bitmap of fixed size
    spot = F.pmod(F.col("h"), F.lit(BITMAP))
    bits = (
        marks.select(F.floor(spot / 64).cast("int").alias("i"), F.expr("shiftleft(1L, cast(pmod(h, 64) as int))").alias("b"))
        .groupBy("i")
        .agg(F.bit_or("b").alias("b"))
        .collect()
    )  # at most BITMAP / 64 rows
    cells = ["0"] * (BITMAP // 64)
    for r in bits:
        cells[r["i"]] = str(r["b"])
    bitmap = F.split(F.lit(",".join(cells)), ",").cast("array<bigint>")  # folded to one literal
    cell = F.get(bitmap, F.floor(spot / 64).cast("int"))
    in_map = F.getbit(cell, F.pmod(F.col("h"), F.lit(64)).cast("int")) == 1
    def places(df: DataFrame) -> DataFrame:
        out = None
        for k in sizes:
            part = _places(df, k).where(in_map).select("doc_id", F.size("ws").alias("n"), "at", "h", F.lit(k).alias("k"))
            out = part if out is None else out.unionByName(part)
        return out

    # a similar window holds one of the item's rarest shingles: stems that many items share name no candidates
    common = marks.groupBy("k", "h").agg(F.count("*").alias("in_items"))
    ascending = Window.partitionBy("item").orderBy("in_items", "h").rowsBetween(Window.unboundedPreceding, -1)
    spare = F.col("m") - F.col("k") + 1 - F.ceil(similarity * (F.col("m") - F.col("k") + 1) - EPSILON)
    rare = (
        marks.join(common, ["k", "h"])
        .withColumn("before", F.coalesce(F.sum("c").over(ascending), F.lit(0)))
        .where(F.col("before") <= spare)
        .select("item", "m", "k", "h")
    )
    pairs = work.table(places(docs).join(rare, ["k", "h"]).select("doc_id", "n", "item", "m", "k").distinct(), "pairs")

    # hits of a pair, and by a running sum over them the starts whose window has enough: linear in the hits
    some = docs.join(pairs.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    hits = (
        places(some)
        .select("doc_id", "at", "h", "k")
        .join(pairs.join(marks.select("item", "h"), "item"), ["doc_id", "k", "h"])
        .select("doc_id", "n", "item", "m", "k", "at")
        .distinct()
    )
    size = F.least("m", "n")  # of the window
    first, last = F.greatest(F.col("at") + F.col("k") - size, F.lit(0)), F.least("at", F.col("n") - size)
    steps = F.array(F.struct(first.alias("start"), F.lit(1).alias("step")), F.struct((last + 1).alias("start"), F.lit(-1).alias("step")))
    steps = (
        hits.select("doc_id", "n", "item", "m", "k", F.explode(steps).alias("e"))
        .groupBy("doc_id", "n", "item", "m", "k", F.col("e.start").alias("start"))
        .agg(F.sum("e.step").alias("step"))
    )
    along = Window.partitionBy("doc_id", "item").orderBy("start")
    both = size + F.col("m") - 2 * F.col("k") + 2  # shingle places of the window and of the item
    windows = (
        steps.withColumn("shared", F.sum("step").over(along))
        .withColumn("until", F.lead("start").over(along))
        .where(F.col("shared") * (1 + similarity) >= similarity * both - EPSILON)
        .select("doc_id", "item", "m", "k", size.alias("size"), F.explode(F.sequence(F.col("start"), F.col("until") - 1)).alias("start"))
    )
    wanted = work.table(windows, "windows")
    asked = wanted.select("doc_id", "m", "k", "start", "size").distinct().groupBy("doc_id").agg(F.collect_list(F.struct("m", "k", "start", "size")).alias("w"))

    # 2. SimHash of windows and items, joined by blocks
    # a merge join at every size: the side that grows with the documents is never broadcast
    whole = texts.join(asked.hint("merge"), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "w", words(F.col("text")).alias("ws"))
    each = whole.select("doc_id", "ws", F.explode("w").alias("w")).select("doc_id", "w.m", "w.k", "w.start", F.slice("ws", F.col("w.start") + 1, F.col("w.size")).alias("ws"))
    grams = work.table(
        _by_size(each, sizes, F.col("k")).groupBy("doc_id", "m", "start", "h").agg(F.count("*").cast("int").alias("c")), "grams"
    )
    prints = (
        _numbered(grams).groupBy("doc_id", "m", "start").agg(*_simhash(), F.count("*").alias("total"))
        .select("doc_id", "m", "start", "total", _packed().alias("sim"))
    )
    item_prints = work.table(
        _numbered(marks).groupBy("item", "item_id", "m").agg(*_simhash(), F.count("*").alias("item_total"))
        .select("item", "item_id", "m", "item_total", _packed().alias("item_sim")),
        "item_prints",
    )
    near = [0] + [1 << a for a in range(8)] + [(1 << a) | (1 << b) for a in range(8) for b in range(a)]

    def variants(j: int) -> Column:
        return F.transform(F.array(*[F.lit(x) for x in near]), lambda x: F.struct(F.lit(j).alias("j"), _block("item_sim", j).bitwiseXOR(x).alias("v")))

    probes = item_prints.select("*", F.explode(F.flatten(F.array(*[variants(j) for j in range(BLOCKS)]))).alias("p")
    ).select("item", "item_id", "m", "item_total", "item_sim", "p.j", "p.v")
    keyed = prints.join(wanted.select("doc_id", "m", "start", "item"), ["doc_id", "m", "start"]).select(
        "*", F.explode(F.array(*[F.struct(F.lit(j).alias("j"), _block("sim", j).alias("v")) for j in range(BLOCKS)])).alias("p")
    ).select("doc_id", "item", "m", "start", "total", "sim", "p.j", "p.v")
    candidates = work.table(
        keyed.join(probes, ["item", "m", "j", "v"])
        .where(F.bit_count(F.col("sim").bitwiseXOR(F.col("item_sim"))) <= RADIUS)
        .select("doc_id", "m", "start", "total", "item", "item_id", "item_total")
        .distinct(),
        "candidates",
    )

    # 3. exact weighted similarity
    mine = marks.select("item", "h", F.col("c").alias("ci"))
    shared = (
        candidates.join(grams, ["doc_id", "m", "start"])
        .join(mine, ["item", "h"])
        .groupBy("doc_id", "m", "start", "item_id", "total", "item_total")
        .agg(F.sum(F.least("c", "ci")).alias("s"))
    )
    value = F.col("s") / (F.col("total") + F.col("item_total") - F.col("s"))
    return (
        shared.withColumn("similarity", value)
        .where(F.col("similarity") >= similarity)
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), F.col("m"))).alias("b"))
        .select("doc_id", "item_id", (-F.col("b.back")).cast("int").alias("start_word"), F.col("b.m").cast("int").alias("n_words"), F.col("b.similarity").alias("similarity"))
    )
