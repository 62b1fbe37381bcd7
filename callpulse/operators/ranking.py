"""Exact area under the ROC curve from rank sums, with ties.

Rows are first summed per score: tied rows count half a win each, so
AUC = sum over scores of pos * (neg below + neg / 2) / (P * N). The number of negatives
below a score is a running sum in two levels: distinct scores are range-partitioned, each
partition's total is summed over the partitions before it, and the running sum inside
a partition starts there. No task sorts all scores, and the sums are whole numbers, so the result is exact
up to one final division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpulse.session import materialize


def exact_auc(df: DataFrame, label: Column, score: Column, by: dict[str, Column] | None = None) -> DataFrame:
    """One row per group: n_pos, n_neg, auc (null unless both classes are there). Rows with a null label or score do not count.

    ``by``: named group expressions; without any, one row over all rows (none if no row counts).
    """
    by = by or {}
    y, keys = label.cast("boolean"), list(by)
    counted = df.select(*[c.alias(k) for k, c in by.items()], y.alias("_y"), score.cast("double").alias("_s"))
    counted = counted.where(F.col("_y").isNotNull() & F.col("_s").isNotNull())
    per_score = counted.groupBy(*keys, "_s").agg(F.count_if("_y").alias("_pos"), F.count_if(~F.col("_y")).alias("_neg"))
    # written once: both levels must see the same partitions
    placed = materialize(per_score.repartitionByRange(*keys, "_s").withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy(*keys, "_part").agg(F.sum("_neg").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)],
        F.col("_part").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    # null groups are groups too
    on = [F.col("_part") == F.col("_of"), *[F.col(k).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)]]
    joined = placed.join(starts, on).select(*keys, "_part", "_s", "_pos", "_neg", "_start")
    inside = Window.partitionBy("_part", *keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_start") + F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    twice = (2 * below + F.col("_neg")).cast("decimal(20,0)") * F.col("_pos").cast("decimal(18,0)")
    g = joined.select(*keys, "_pos", "_neg", twice.alias("_wins"))
    out = g.groupBy(*keys).agg(F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"), F.sum("_wins").cast("double").alias("_wins"))
    if not keys:
        out = out.where(F.col("n_pos").isNotNull())
    area = F.col("_wins") / (F.lit(2.0) * F.col("n_pos") * F.col("n_neg"))
    return out.select(*keys, "n_pos", "n_neg", F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0), area).alias("auc"))
