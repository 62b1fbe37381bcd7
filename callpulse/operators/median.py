"""Exact (optionally weighted) medians of many columns with bounded per-task state.

Spark's exact ``percentile`` keeps one map entry per distinct value and merges
them in a single final task, which does not stay bounded for continuous
columns over very many keys. Here all columns are handled together in three
passes:

1. per column: total weight of the non-null values and approximate quantile
   boundaries (``percentile_approx`` sketches, bounded memory);
2. every value gets a bucket (``Bucketizer``, binary search in the JVM) and
   weights are summed per (column, bucket): at most columns x buckets rows
   reach the driver, which finds the bucket holding each middle rank and the
   rank left inside that bucket;
3. only rows of those buckets: weight per distinct value, running sum in value
   order inside each (column, bucket) slice, and the value at the residual rank.

The result equals the median of the rows repeated ``weight`` times (the two
middle values averaged when the total weight is even), i.e. pandas ``median``
of the per-call table and Spark ``percentile(x, 0.5, weight)``.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _middle_ranks(total: int) -> tuple[int, int]:
    if total % 2:
        r = (total + 1) // 2
        return r, r
    return total // 2, total // 2 + 1


def exact_medians(
    df: DataFrame,
    cols,
    weight: str | None = None,
    buckets: int = 128,
    accuracy: int = 1000,
) -> dict[str, float | None]:
    """Exact medians of ``cols`` (each row counted ``weight`` times); nulls and NaN do not count."""
    cols = list(cols)
    spark = df.sparkSession
    w = (F.col(weight) if weight else F.lit(1)).cast("long")
    xs = [f"_x{i}" for i in range(len(cols))]
    base = df.select(*[F.col(c).cast("double").alias(x) for c, x in zip(cols, xs)], w.alias("_w"))
    qs = [j / buckets for j in range(1, buckets)]

    # pass 1: totals and sketch boundaries (one row)
    row = base.agg(
        *[F.sum(F.when(F.col(x).isNotNull() & ~F.isnan(x), F.col("_w"))).alias(f"W{i}") for i, x in enumerate(xs)],
        *[F.percentile_approx(F.nanvl(F.col(x), F.lit(None).cast("double")), qs, accuracy).alias(f"B{i}") for i, x in enumerate(xs)],
    ).first()
    result: dict[str, float | None] = {c: None for c in cols}
    live = [i for i in range(len(cols)) if row[f"W{i}"]]
    if not live:
        return result
    splits = []
    for i in live:
        inner = sorted({float(b) for b in (row[f"B{i}"] or []) if b is not None and not math.isnan(b)})
        splits.append([-math.inf] + inner + [math.inf])

    # pass 2: weight per (column, bucket)
    nan = F.lit(float("nan"))
    filled = base.select(*[F.coalesce(F.col(xs[i]), nan).alias(xs[i]) for i in live], "_w")
    bucketed = Bucketizer(
        splitsArray=splits, inputCols=[xs[i] for i in live], outputCols=[f"_k{i}" for i in live], handleInvalid="keep"
    ).transform(filled)
    long = (
        bucketed.select(
            F.explode(
                F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"_k{i}").alias("k"), F.col(xs[i]).alias("x")) for i in live])
            ).alias("s"),
            "_w",
        )
        .select("s.c", "s.k", "s.x", "_w")
        .where(~F.isnan("x"))
    )
    hist: dict[int, list[tuple[float, int]]] = {}
    for r in long.groupBy("c", "k").agg(F.sum("_w").alias("w")).collect():
        hist.setdefault(r["c"], []).append((r["k"], r["w"]))
    targets = []  # (column, bucket, residual rank, which)
    for i in live:
        ranks = _middle_ranks(int(row[f"W{i}"]))
        cum = 0
        for k, wk in sorted(hist.get(i, [])):
            for which, r in enumerate(ranks):
                if cum < r <= cum + wk:
                    targets.append((i, float(k), r - cum, which))
            cum += wk

    # pass 3: value at the residual rank inside the selected buckets only
    t = spark.createDataFrame(targets, "c int, k double, rr long, which int")
    picked = long.join(F.broadcast(t.select("c", "k").distinct()), ["c", "k"])
    sl = picked.groupBy("c", "k", "x").agg(F.sum("_w").alias("w"))
    run = Window.partitionBy("c", "k").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sl = sl.withColumn("cum", F.sum("w").over(run))
    hits = (
        sl.join(F.broadcast(t), ["c", "k"])
        .where((F.col("cum") - F.col("w") < F.col("rr")) & (F.col("rr") <= F.col("cum")))
        .select("c", "which", "x")
        .collect()
    )
    vals: dict[int, dict[int, float]] = {}
    for h in hits:
        vals.setdefault(h["c"], {})[h["which"]] = h["x"]
    for i in live:
        v = vals.get(i, {})
        if 0 in v and 1 in v:
            lo, hi = v[0], v[1]
            result[cols[i]] = lo + (hi - lo) * 0.5
    return result
