"""Single-pass call-feature plan against one group-by per feature (measurement only).

``python -m callpulse.plans.naive_compare [sf_dir]`` starts both from the same
written call window and prints, for each, the wall seconds (median of 3) and
the number of shuffle exchanges in the executed plan. The naive plan mirrors a
per-feature pandas layout: one aggregation per feature over the call rows,
then full outer joins on KEY.
"""

from __future__ import annotations

import json
import statistics
import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callpulse.config import KEY, Config
from callpulse.functions.timefns import floor_days


def naive_features(cw: DataFrame, cfg: Config) -> DataFrame:
    d, k = F.col("duration_s"), list(KEY)
    real = d > cfg.real_call_s
    d_in, d_out = F.col("direction") == "in", F.col("direction") == "out"
    expert = F.col("role_id").isin(*cfg.expert_roles)
    kept = ~F.coalesce(F.col("manager_name").isin(*cfg.excluded_managers), F.lit(False))

    def cnt(cond, name):
        return cw.where(cond).groupBy(*k).agg(F.count(F.lit(1)).alias(name))

    feats = [
        cw.groupBy(*k).agg(F.count("start_time").alias("n_calls_global")),
        cnt(d_in, "in_global"),
        cnt(d_out, "out_global"),
        cw.where(real).groupBy(*k).agg(F.min("start_time").alias("first_call")),
        cw.where(real).groupBy(*k).agg(F.max("start_time").alias("last_call")),
        cw.groupBy(*k).agg(F.avg(d).alias("avg_duration")),
        cnt(d_in & d.isNull() & expert, "unanswered_in"),
        cnt(d_out & d.isNull(), "unanswered_out"),
        cnt(d > cfg.long_call_s, "n_calls_gt_600"),
        cnt(d >= cfg.medium_call_s, "n_calls_ge_180"),
        cnt((d >= cfg.voicemail_min_s) & (d < cfg.voicemail_max_s) & d_out, "n_voicemails"),
        cw.where(d_in).groupBy(*k).agg(F.sum(d).alias("duration_in")),
        cw.groupBy(*k).agg(F.sum(d).alias("total_duration")),
        cw.groupBy(*k).agg(F.count("missed_status").alias("n_missed_rows")),
        cnt(F.col("missed_status") == "no_callback", "n_no_callback_rows"),
        cw.where(real)
        .groupBy(*k, F.to_date("start_time").alias("day"))
        .count()
        .where("count > 1")
        .groupBy(*k)
        .agg(F.count(F.lit(1)).alias("multi_call_days_global")),
        cw.where(real & kept).groupBy(*k).agg(F.countDistinct("agent_norm").alias("n_interlocutors")),
        cw.where(F.col("agent").isNotNull())
        .groupBy(*k, "agent")
        .agg(F.min("start_time").alias("s"), F.min("first_expert_call").alias("f"))
        .groupBy(*k)
        .agg(F.median(F.greatest(floor_days("s", "f"), F.lit(0))).alias("agent_experience_days")),
        cw.where(real & d_out)
        .withColumn("prev", F.lag("start_time").over(Window.partitionBy(*k).orderBy("start_time", "call_id")))
        .where(floor_days("start_time", "prev") > cfg.gap_days)
        .groupBy(*k)
        .agg(F.count(F.lit(1)).alias("n_gaps_14d")),
    ]
    out = feats[0]
    for f in feats[1:]:
        out = out.join(f, k, "full")
    return out


def _run(df: DataFrame) -> float:
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main(argv: list[str]) -> None:
    from callpulse.operators.calls import call_features_raw
    from callpulse.plans.catalog import Ctx
    from callpulse.session import get_session, materialize

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    ctx = Ctx(spark, sf_dir)
    cw = materialize(ctx.call_window)
    result = {}
    for name, build in (("single_pass", lambda: call_features_raw(cw, ctx.cfg)), ("naive", lambda: naive_features(cw, ctx.cfg))):
        times, shuffles = [], 0
        for _ in range(3):
            t0 = time.perf_counter()
            df = build()
            times.append(time.perf_counter() - t0 + _run(df))
            shuffles = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        result[name] = {"sec": round(statistics.median(times), 2), "hash_exchanges_final_plan": shuffles}
    print(json.dumps({"sf_dir": sf_dir, **result}))


if __name__ == "__main__":
    main(sys.argv[1:])
