"""Rows that are kept by opportunity are not shuffled again on the way to the matrix."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from callpulse.config import CRM_DATE_COLUMNS, MODEL_FEATURES, Config
from callpulse.operators import assemble as AS
from callpulse.operators import cells as CE
from callpulse.operators import crm as CR
from callpulse.operators import warehouse as WH
from callpulse.plans import catalog
from callpulse.session import materialize

CFG = Config()
D = dt.datetime


def _hashed(df):
    """Columns of each hash exchange of the plan."""
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"hashpartitioning\(([^()]*), \d+\)", df._jdf.queryExecution().executedPlan().toString())]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _opps(spark):
    cols = [c for c in dict.fromkeys([*WH.OPP_COLUMNS, "owner_id"]) if c not in ("owner_name", "to_reach_at", "r1_at", "search_no_docs_at", "search_docs_at", "assembly_at", "sent_at")]
    values = {"opp_id": F.col("id"), "account_id": F.col("id") % 3, "owner_id": F.col("id") % 2, "stage": F.lit("r1"), "channel": F.lit("x"), "record_type_id": F.lit("MAIN")}
    at = F.lit(D(2024, 1, 1)).cast("timestamp_ntz")
    opps = spark.range(12).select(*[values.get(c, at).alias(c) for c in cols])
    stages = spark.range(9).select(F.col("id").alias("opp_id"), *[at.alias(c) for c in CRM_DATE_COLUMNS if c not in cols])
    users = spark.createDataFrame([(0, "A"), (0, "B")], "user_id long, name string")  # a repeated user gives its opportunities twice
    return opps, stages, users


def _labels(spark):
    rows = [(i, i % 3 if i != 4 else 0, D(2024, 1, 5 + s), 4.0, D(2024, 1, 2), -3) for i in range(1, 12) for s in (0, 1)]
    rows += [(5, None, D(2024, 1, 5), 4.0, D(2024, 1, 2), -3), (None, 1, D(2024, 1, 5), 4.0, D(2024, 1, 2), -3)]
    return spark.createDataFrame(rows, "opp_id long, account_id long, ref_date timestamp_ntz, rating double, mandate_date timestamp_ntz, mandate_delta_days long")


def test_opportunities_with_stages_meet_labels_where_they_are(spark, no_broadcast):
    opps, stages, users = _opps(spark)
    clean = CR.crm_clean(WH.opps_train(opps, stages, users, CFG), _labels(spark), CFG)
    # owners, opportunities for the stages (twice each: both sides), then the labels alone
    assert sorted(_hashed(clean)) == ["_opp", "opp_id", "opp_id", "owner_id", "owner_id"]
    got = sorted((r["opp_id"], r["account_id"], r["ref_date"].day) for r in clean.collect())
    # account and opportunity must both be the label's; opportunity 4 is another account's, null matches nothing
    assert got == sorted((i, i % 3, 5 + s) for i in range(1, 12) if i != 4 for s in (0, 1) for _ in range(1 if i % 2 else 2))


def test_imputation_groups_the_matrix_where_it_is(spark, no_broadcast, monkeypatch):
    keys = [(a, o, D(2024, 1, d)) for a, o in ((1, 10), (1, 11), (2, 20)) for d in (3, 9)]
    crm_only = [*AS.CRM_FEATURE_COLUMNS, "mandate_delta_days"]
    side = [c for c in MODEL_FEATURES if c not in crm_only]
    calls = spark.createDataFrame(keys, "account_id long, opp_id long, ref_date timestamp_ntz").select("*", *[F.dayofmonth("ref_date").cast("double").alias(c) for c in side])
    crm = calls.where("opp_id <> 11 and day(ref_date) = 9").select(
        "account_id", "opp_id", "ref_date", F.lit(4.0).alias("rating"), *[(F.col("opp_id") + i).cast("double").alias(c) for i, c in enumerate(crm_only)]
    )
    m = AS.features_joined(calls, crm, checkpoint=False)
    assert m.count() == 6 and m.where("rating is null").count() == 4 and m.columns[:3] == ["account_id", "opp_id", "ref_date"]
    plans = []
    keep = AS.materialize
    monkeypatch.setattr(AS, "materialize", lambda df: plans.append(_hashed(df)) or keep(df))
    out = AS.impute_trace(m, CFG)
    assert plans == [["account_id, opp_id", "_account_id, _opp_id"]]
    assert sorted((r["opp_id"], r["n_calls_global"], r["mandate_delta_days"]) for r in out.collect()) == [(o, 9.0, float(o + len(crm_only) - 1)) for o in (10, 20)]


def _register(spark):
    """Three calls of one agent on one day, one of another, one without a start."""
    cols = "call_id long, opp_id long, account_id long, direction string, start_time timestamp_ntz, duration_s double, agent string, manager_name string, role_id string, "
    cols += ", ".join(f"{c} long" for c in WH.PUNCTUALITY_COLUMNS) + ", absence_flag string"
    at = [D(2024, 1, 3, 9), D(2024, 1, 3, 10), D(2024, 1, 3, 11), D(2024, 1, 3, 12), None]
    rows = [(i, 10, 1, "in", t, 60.0 * i, "A" if i < 3 else "B", "M", "EXPERT", i, 0, 0, 0, 0, WH.WORK) for i, t in enumerate(at)]
    return spark.createDataFrame(rows, cols)


def test_calls_go_to_their_cell_before_they_are_summed(spark):
    cells = CE.day_cells(_register(spark), CFG)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert _hashed(cells) == ["account_id, opp_id, slot, agent"]
    assert "Aggregate" not in plan[plan.index("hashpartitioning"):]
    got = sorted((r["agent"], r["n_rows"], r["sum_dur"], r["last_no_show"], r["max_start"].hour) for r in cells.collect())
    assert got == [("A", 3, 180.0, 2, 11), ("B", 1, 180.0, 3, 12)]


def test_intermediate_tables_are_packed(spark):
    t = materialize(spark.range(5))
    assert sorted(r["id"] for r in t.collect()) == list(range(5))
    assert all(f.endswith(".zstd.parquet") for f in t.inputFiles())


@pytest.mark.parametrize("name", ["call_mix_global", "call_features_distinct"])
def test_labels_that_only_the_call_side_reads_are_not_written(spark, monkeypatch, name):
    written = []
    for m in (catalog, CE):
        monkeypatch.setattr(m, "materialize", lambda df: written.append(df.columns) or materialize(df))
    catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert written and not any("mandate_delta_days" in c for c in written)


def test_labels_that_the_matrix_reads_too_are_derived_once(spark, monkeypatch):
    c = catalog.Ctx(spark, "/root/testdata/sf0.001")
    seen = []
    monkeypatch.setattr(catalog.CE, "features_from_cells", lambda cells, labels, cfg: seen.append(labels) or labels)
    c.cells = None
    kept = c.labels
    assert c.call_raw is kept and seen == [kept]
