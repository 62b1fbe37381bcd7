"""Hand-made micro frames, one per semantic trap of the feature definitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from callpulse.config import Config
from callpulse.functions.exprs import cap
from callpulse.functions.timefns import floor_days, minutes_between, round_to_day
from callpulse.operators import alerts as AL
from callpulse.operators import assemble as AS
from callpulse.operators import calls as CA
from callpulse.operators import crm as CR
from callpulse.operators import labels as LA
from callpulse.operators import ml as ML
from tests.frames import REF, call, cw

CFG = Config()
D = dt.datetime


def _one(df, col):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0][col]


def test_floor_days_and_minutes(spark):
    df = spark.createDataFrame(
        [(D(2021, 1, 1, 0), D(2021, 1, 1, 1)), (D(2021, 1, 2, 1), D(2021, 1, 1, 0)), (D(2021, 1, 2, 0, 1), D(2021, 1, 1, 23, 59))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    out = [r[0] for r in df.select(floor_days("a", "b")).collect()]
    assert out == [-1, 1, 0]
    m = spark.createDataFrame([(D(2021, 1, 1, 12, 0, 0), D(2021, 1, 1, 11, 58, 30))], "a timestamp_ntz, b timestamp_ntz")
    assert m.select(minutes_between("a", "b")).first()[0] == -1


def test_day_round_half_even(spark):
    df = spark.createDataFrame([(D(2021, 1, 1, 12),), (D(2021, 1, 2, 12),), (D(2021, 1, 1, 13),)], "t timestamp_ntz")
    out = [r[0] for r in df.select(round_to_day("t")).collect()]
    assert out == [D(2021, 1, 1), D(2021, 1, 3), D(2021, 1, 2)]


def test_cap_keeps_null(spark):
    df = spark.createDataFrame([(None,), (4000.0,), (10.0,)], "d double")
    assert [r[0] for r in df.select(cap("d", 3600.0)).collect()] == [None, 3600.0, 10.0]


def test_null_manager_kept_by_not_in(spark):
    rows = [
        call(1, D(2024, 2, 1), duration=30.0, agent="A", manager=None),
        call(2, D(2024, 2, 2), duration=30.0, agent="B", manager=CFG.excluded_managers[0]),
        call(3, D(2024, 2, 3), duration=30.0, agent="C", manager="other"),
    ]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False)
    assert _one(f, "n_interlocutors") == 2


def test_all_null_inbound_sum_is_zero(spark):
    rows = [call(1, D(2024, 2, 1), duration=None), call(2, D(2024, 2, 2), direction="out", duration=100.0)]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False)
    assert _one(f, "duration_in") == 0.0
    rows = [call(1, D(2024, 2, 2), direction="out", duration=100.0)]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False)
    assert _one(f, "duration_in") is None


def test_last_direction_skips_null(spark):
    rows = [call(1, D(2024, 2, 1), direction="in"), call(2, D(2024, 2, 5), direction=None)]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False)
    assert _one(f, "last_call_out") == 0
    rows = [call(1, D(2024, 2, 1), direction=None)]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False)
    assert _one(f, "last_call_out") == 1


def test_gap_edge(spark):
    base = D(2024, 1, 1)
    rows = [
        call(1, base, direction="out", duration=30.0),
        call(2, base + dt.timedelta(days=14, hours=23), direction="out", duration=30.0),
        call(3, base + dt.timedelta(days=14, hours=23) + dt.timedelta(days=15), direction="out", duration=30.0),
    ]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False)
    assert _one(f, "n_gaps_14d") == 1


def test_gap_skips_days_without_outbound(spark):
    base = D(2024, 1, 1)
    rows = [
        call(1, base, direction="out", duration=30.0),
        call(2, base + dt.timedelta(days=8), direction="in", duration=30.0),
        call(3, base + dt.timedelta(days=20), direction="out", duration=30.0),
    ]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False)
    assert _one(f, "n_gaps_14d") == 1


def test_empty_category_gives_zero(spark):
    rows = [call(1, D(2024, 2, 1), role="OTHER")]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False)
    r = f.first()
    assert (r["n_calls_bizdev"], r["pct_in_bizdev"], r["pct_out_bizdev"]) == (0, 0.0, 0.0)


def test_multi_call_days_windows(spark):
    rows = [
        call(1, D(2024, 2, 27, 9), duration=30.0),
        call(2, D(2024, 2, 27, 10), duration=30.0),
        call(3, D(2024, 2, 10, 9), duration=30.0),
        call(4, D(2024, 2, 10, 10), duration=30.0),
        call(5, D(2024, 2, 11, 10), duration=5.0),
    ]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False).first()
    assert (f["multi_call_days_global"], f["multi_call_days_14d"], f["multi_call_days_7d"]) == (2, 1, 1)


def test_no_multi_call_day_is_null(spark):
    f = CA.call_features_raw(cw(spark, [call(1, D(2024, 2, 27, 9))]), CFG, checkpoint=False).first()
    assert f["multi_call_days_global"] is None and f["multi_call_days_7d"] is None


def test_sparse_median_is_call_weighted(spark):
    df = spark.createDataFrame([(1.0, 1), (5.0, 2), (9.0, 9), (None, 3)], "x double, n_rows int")
    m = AS.fit_medians(df, ["x"], weight="n_rows")
    assert m["x"] == 9.0  # rows: 1, 5, 5, 9 x9 -> median 9


def test_one_status_total_missed_zero(spark):
    rows = [call(1, D(2024, 2, 1), missed="no_callback"), call(2, D(2024, 2, 2))]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False).first()
    assert f["no_callback_count"] == 1.0 and f["same_day_callback_count"] is None and f["total_missed"] == 0.0


def test_punctuality_of_last_call_with_stats(spark):
    rows = [
        call(1, D(2024, 2, 1), punct=(5, 4, 3, 2, 1)),
        call(2, D(2024, 2, 3), punct=(None, None, None, None, None)),
    ]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False).first()
    assert f["no_show"] == 5 and f["late_ge_15"] == 1


def test_experience_median_and_clamp(spark):
    rows = [
        call(1, D(2024, 2, 1), agent="A", first_expert=D(2024, 1, 1)),
        call(2, D(2024, 2, 1), agent="B", first_expert=D(2024, 3, 1)),
        call(3, D(2024, 2, 1), agent="C", first_expert=None),
    ]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False).first()
    assert f["agent_experience_days"] == (31 + 0) / 2


def test_key_without_named_agent_dropped(spark):
    f = CA.call_features_raw(cw(spark, [call(1, D(2024, 2, 1), agent=None)]), CFG, checkpoint=False)
    assert f.count() == 0


def _crm_frame(spark, **over):
    cols = {
        "opp_id": 1,
        "account_id": 1,
        "created_at": D(2024, 1, 1),
        "to_reach_at": None,
        "r1_at": None,
        "search_no_docs_at": None,
        "search_docs_at": None,
        "assembly_at": None,
        "sent_at": None,
        "lost_at": None,
        "offer_edited_at": None,
        "mandate_signed_at": D(2024, 1, 5),
        "compromise_at": None,
        "suspensive_at": None,
    }
    cols.update(over)
    schema = T.StructType(
        [T.StructField("opp_id", T.LongType()), T.StructField("account_id", T.LongType())]
        + [T.StructField(c, T.TimestampNTZType()) for c in list(cols)[2:]]
    )
    opps = spark.createDataFrame([tuple(cols.values())], schema)
    lab = spark.createDataFrame(
        [(1, 1, D(2024, 6, 1), 5.0, D(2024, 1, 5), -148)],
        "opp_id long, account_id long, ref_date timestamp_ntz, rating double, mandate_date timestamp_ntz, mandate_delta_days long",
    )
    return opps, lab


def test_clean_order_fill_93_days(spark):
    opps, lab = _crm_frame(spark, compromise_at=D(2024, 1, 10))
    r = CR.crm_clean(opps, lab, CFG).first()
    assert r["suspensive_at"] == D(2024, 1, 10) + dt.timedelta(days=93)
    opps, lab = _crm_frame(spark, suspensive_at=D(2024, 5, 1))
    r = CR.crm_clean(opps, lab, CFG).first()
    assert r["compromise_at"] == D(2024, 5, 1) - dt.timedelta(days=93)


def test_point_in_time_mask(spark):
    opps, lab = _crm_frame(spark, sent_at=D(2024, 7, 1), r1_at=D(2024, 2, 1))
    r = CR.crm_clean(opps, lab, CFG).first()
    assert r["sent_at"] is None and r["r1_at"] == D(2024, 2, 1)


def test_stage_tie_later_wins_and_all_null(spark):
    opps, lab = _crm_frame(spark, search_docs_at=D(2024, 3, 1), assembly_at=D(2024, 3, 1))
    r = CR.crm_features(CR.crm_clean(opps, lab, CFG)).first()
    assert r["last_stage"] == "assembly_at"
    opps, lab = _crm_frame(spark)
    r = CR.crm_features(CR.crm_clean(opps, lab, CFG)).first()
    assert r["last_stage"] == "" and r["last_stage_at"] is None


def test_rating_edges(spark):
    df = spark.createDataFrame([(3.0,), (3.5,), (4.0,), (5.0,), (None,)], "rating double")
    out = sorted((r["rating"] is None, r["rating"], r["is_good"]) for r in ML.label_is_good(df, CFG).collect())
    assert out == [(False, 3.0, False), (False, 5.0, True), (True, None, False)]


def test_keep_first_closest_after_mandate(spark):
    m = spark.createDataFrame([(1, D(2024, 1, 1, 10))], "opp_id long, received_at timestamp_ntz")
    r = spark.createDataFrame(
        [
            (1, 9, D(2024, 1, 20), 5.0, "nps", 1),
            (1, 9, D(2024, 1, 10), 1.0, "nps", 2),
            (1, 9, D(2023, 12, 20), 2.0, "nps", 3),
        ],
        "opp_id long, account_id long, review_ts timestamp_ntz, rating double, source string, review_id long",
    )
    out = LA.labels_train(m, r, CFG).collect()
    assert len(out) == 1 and out[0]["rating"] == 1.0 and out[0]["mandate_delta_days"] == -9


def test_shift_copies_keep_delta(spark):
    lab = spark.createDataFrame(
        [(1, 9, D(2024, 2, 1), 5.0, D(2024, 1, 1), -31)],
        "opp_id long, account_id long, ref_date timestamp_ntz, rating double, mandate_date timestamp_ntz, mandate_delta_days long",
    )
    out = sorted((r["ref_date"], r["mandate_delta_days"]) for r in LA.shift_labels(lab, CFG).collect())
    assert out == [(D(2024, 1, 18), -31), (D(2024, 2, 1), -31)]


def test_alert_window(spark):
    latest = spark.createDataFrame(
        [(D(2024, 1, 30), 1, "u1", 10.0), (D(2024, 1, 30), 2, "u2", 20.0)],
        "date_pred timestamp_ntz, opp_id long, url string, proba double",
    )
    hist = spark.createDataFrame(
        [(D(2024, 1, 23), 1, "u1", 10.0, "done"), (D(2024, 1, 22), 2, "u2", 20.0, "")],
        "date_pred timestamp_ntz, opp_id long, url string, proba double, treatment string",
    )
    out = AL.new_alerts(latest, hist, CFG).collect()
    assert [r["opp_id"] for r in out] == [2]


def test_double_label_counts_twice(spark):
    rows = [call(1, D(2024, 2, 1), opp=10), call(1, D(2024, 2, 1), opp=10)]
    f = CA.call_features_raw(cw(spark, rows), CFG, checkpoint=False).first()
    assert f["n_calls_global"] == 2


def test_window_join_bounds(spark):
    base = spark.createDataFrame(
        [
            (1, 10, 1, D(2024, 1, 1, 12), "in", 30.0, "A", "A", "M", "EXPERT", None, *([None] * 5), "work"),
            (2, 10, 1, D(2024, 3, 1, 0), "in", 30.0, "A", "A", "M", "EXPERT", None, *([None] * 5), "work"),
            (3, 10, 1, D(2023, 12, 1), "in", 30.0, "A", "A", "M", "EXPERT", None, *([None] * 5), "work"),
        ],
        "call_id long, opp_id long, account_id long, start_time timestamp_ntz, direction string, duration_s double, "
        "agent string, expert_name string, manager_name string, role_id string, missed_status string, no_show long, "
        "on_time long, late_lt5 long, late_lt15 long, late_ge_15 long, absence_flag string",
    )
    lab = spark.createDataFrame(
        [(10, 1, REF, 5.0, D(2024, 1, 1), -60)],
        "opp_id long, account_id long, ref_date timestamp_ntz, rating double, mandate_date timestamp_ntz, mandate_delta_days long",
    )
    out = sorted(r["call_id"] for r in CA.call_window(base, lab, CFG).collect())
    assert out == [1]  # 2 is at the reference time, 3 is more than 60 days before
    assert F is not None
