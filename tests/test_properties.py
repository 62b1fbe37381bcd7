"""Properties of the feature matrix, the labels and the alerts on real test tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from callpulse.config import KEY, Config
from callpulse.functions.timefns import add_days
from callpulse.operators import alerts as AL
from callpulse.operators import assemble as AS
from callpulse.operators import calls as CA
from callpulse.plans.catalog import Ctx
from callpulse.sources import adapters as A

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ctx(spark):
    return Ctx(spark, SF)


def test_key_unique(ctx):
    f = ctx.call_raw
    assert f.count() == f.select(*KEY).distinct().count() > 0


def test_call_mix_percentages(ctx):
    f = ctx.call_raw
    bad = f.where((F.col("in_global") + F.col("out_global") > 0) & (F.abs(F.col("pct_in_global") + F.col("pct_out_global") - 100) > 1e-9))
    assert bad.count() == 0


def test_recent_windows_nested(ctx):
    f = ctx.call_raw.where(F.col("multi_call_days_global").isNotNull())
    bad = f.where((F.col("multi_call_days_7d") > F.col("multi_call_days_14d")) | (F.col("multi_call_days_14d") > F.col("multi_call_days_global")))
    assert bad.count() == 0


def test_no_leak_from_later_calls(ctx):
    cfg = ctx.cfg
    base = ctx.call_base("agent")
    later = base.withColumn("start_time", add_days("start_time", 400)).withColumn("call_id", F.col("call_id") + 10**9)
    a = CA.call_features_raw(CA.call_window(base, ctx.labels_shifted, cfg), cfg, checkpoint=False)
    b = CA.call_features_raw(CA.call_window(base.unionByName(later), ctx.labels_shifted, cfg), cfg, checkpoint=False)
    cols = [c for c in a.columns]
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def test_labels_one_per_opp_and_after_mandate(ctx):
    lab = ctx.labels_train
    assert lab.count() == lab.select("opp_id").distinct().count()
    assert lab.where(F.col("mandate_delta_days") >= 0).count() == 0


def test_new_alerts_disjoint_from_recent_history(ctx):
    cfg = ctx.cfg
    latest = AL.alerts_ranked(A.scores(ctx.t), ctx.opps, cfg)
    hist = AL.merge_history(A.alert_history(ctx.t), A.previous_alerts(ctx.t))
    new = AL.new_alerts(latest, hist, cfg)
    newest = latest.agg(F.max("date_pred")).first()[0]
    if newest is None:
        return
    recent = hist.where(F.col("date_pred") > F.lit(newest - dt.timedelta(days=cfg.alert_recent_days))).select("opp_id")
    assert new.join(recent, "opp_id").count() == 0


def test_weighted_median_matches_repeated_rows(spark):
    rows = [(float(x), n) for x, n in [(1, 3), (2, 1), (7, 2), (4, 5)]]
    df = spark.createDataFrame(rows, "x double, n_rows int")
    got = AS.fit_medians(df, ["x"], weight="n_rows")["x"]
    import statistics

    assert got == statistics.median([x for x, n in rows for _ in range(n)])


def test_config_feature_order_shared():
    from callpulse.config import MODEL_FEATURES

    assert len(MODEL_FEATURES) == 37 and len(set(MODEL_FEATURES)) == 37
    assert Config().num_trees == 500
