"""Token totals for every context limit from an exact histogram of encoded lengths.

Documents are aggregated by their number of tokens; the histogram is the only
thing kept, pre-aggregated in every task. For a context limit L, sums over the
lengths of at least L (suffix sums) give how many documents are cut, what is
lost, and the truncated total; prefix counts give the quantiles.

The running sums are made in two levels, so no task sorts the whole histogram:
lengths are ranged into blocks of ``BLOCK``, block totals are summed over the
blocks, and each block adds its own rows. The number of blocks is the longest
document's tokens divided by ``BLOCK``.

Edge cases: null and empty texts have length 0; repeated rows count as often as
they occur; ids and other columns are not read; an empty table gives an empty
result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callpulse.llm.bpe import _lots, tokenizer

BLOCK = 256


def _lengths(path: str):
    def run(batches):
        tok = tokenizer(path)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in _lots(texts):
                parts = tok.prepare([t or "" for t in texts[a:b]])
                n = [sum([x.count(",") for x in map(tok.ids.__getitem__, p)]) for p in parts]
                yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["length"])
        tok.forget()

    return run


def length_histogram(docs: DataFrame, path: str) -> DataFrame:
    """length, n_docs: documents of each encoded length."""
    return (
        docs.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(_lengths(path), "length long")
        .groupBy("length")
        .agg(F.count("*").alias("n_docs"))
    )


def context_totals(histogram: DataFrame) -> DataFrame:
    """One row per distinct length, read as a context limit.

    n_docs; docs_up_to (not longer); docs_longer; tokens (of this length); tokens_total
    (all documents); tokens_truncated (every document cut at this limit); quantile
    (share of documents not longer than the limit).
    """
    h = histogram.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d0"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
        F.sum("d").over(every).alias("docs_total"),
        F.sum("t").over(every).alias("tokens_total"),
    )
    inner = Window.partitionBy("block").orderBy("length")
    return (
        h.join(blocks, "block")
        .withColumn("docs_up_to", F.col("d0") + F.sum("n_docs").over(inner))
        .withColumn("t_up_to", F.col("t0") + F.sum("tokens").over(inner))
        .select(
            F.col("length").alias("context_limit"),
            "n_docs",
            "tokens",
            "docs_up_to",
            (F.col("docs_total") - F.col("docs_up_to")).alias("docs_longer"),
            "tokens_total",
            (F.col("t_up_to") + F.col("length") * (F.col("docs_total") - F.col("docs_up_to"))).alias("tokens_truncated"),
            (F.col("docs_up_to") / F.col("docs_total")).alias("quantile"),
        )
    )


def totals_at(histogram: DataFrame, limits: DataFrame) -> DataFrame:
    """The rows of ``context_totals`` for any limits (column ``limit``), also those that no document has.

    A limit joins the histogram as a length of no documents, so the same suffix sums answer it. Null and negative limits
    have no row; repeated ones have one; on an empty histogram there is none.
    """
    asked = limits.select(F.col("limit").cast("long").alias("length")).where("length >= 0").distinct()
    known = histogram.select("length", F.col("n_docs").cast("long").alias("n_docs"))
    both = known.unionByName(asked.select("length", F.lit(0).cast("long").alias("n_docs"))).groupBy("length").agg(F.sum("n_docs").alias("n_docs"))
    rows = context_totals(both).where(F.col("docs_up_to") + F.col("docs_longer") > 0)
    return rows.join(asked.withColumnRenamed("length", "context_limit"), "context_limit", "left_semi")


def lengths_at(histogram: DataFrame, shares: DataFrame) -> DataFrame:
    """share, length: the smallest length that at least this share of the documents does not exceed (column ``share``, 0 to 1).

    A share is a rank among the documents; it finds its block among the block totals (as many rows as the longest
    document has blocks), then its length among the rows of that block. Null shares and those outside 0 to 1 have no row.
    """
    t = context_totals(histogram).select(
        F.col("context_limit").alias("length"), F.col("docs_up_to").alias("upto"), "n_docs", (F.col("docs_up_to") + F.col("docs_longer")).alias("all")
    )
    t = t.withColumn("block", F.floor(F.col("length") / BLOCK))
    blocks = t.groupBy("block").agg(F.min(F.col("upto") - F.col("n_docs")).alias("lo"), F.max("upto").alias("hi"), F.max("all").alias("all"))
    asked = shares.select(F.col("share").cast("double").alias("share")).where("share between 0 and 1").distinct()
    rank = F.greatest(F.ceil(F.col("share") * F.col("all")), F.lit(1))
    placed = asked.join(blocks, (rank > F.col("lo")) & (rank <= F.col("hi"))).select("share", "block", rank.alias("rank"))
    inside = (F.col("rank") > F.col("upto") - F.col("n_docs")) & (F.col("rank") <= F.col("upto"))
    return placed.join(t, "block").where(inside).select("share", "length")
