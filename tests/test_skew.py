"""A hot account (half of all calls) gives the same features with and without AQE skew splitting."""

from __future__ import annotations

import datetime as dt

from callpulse.config import Config
from callpulse.operators import calls as CA

CFG = Config()


def _base(spark):
    rows = []
    cid = 0
    for acc in range(40):
        n = 400 if acc == 0 else 10  # account 0 holds half of the calls
        for j in range(n):
            cid += 1
            rows.append(
                (
                    cid,
                    acc * 10 + j % 3,
                    acc,
                    dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * j + acc),
                    "in" if j % 3 else "out",
                    float((j * 37) % 900),
                    f"Agent {j % 7}",
                    f"Agent {j % 7}",
                    "M",
                    "EXPERT" if j % 2 else "BIZDEV",
                    "no_callback" if j % 11 == 0 else None,
                    1,
                    1,
                    1,
                    1,
                    0,
                    "work",
                )
            )
    base = spark.createDataFrame(
        rows,
        "call_id long, opp_id long, account_id long, start_time timestamp_ntz, direction string, duration_s double, "
        "agent string, expert_name string, manager_name string, role_id string, missed_status string, no_show long, "
        "on_time long, late_lt5 long, late_lt15 long, late_ge_15 long, absence_flag string",
    )
    labels = spark.createDataFrame(
        [(acc * 10 + k, acc, dt.datetime(2024, 2, 1 + k * 7), 4.0, dt.datetime(2023, 12, 1), -60) for acc in range(40) for k in range(3)],
        "opp_id long, account_id long, ref_date timestamp_ntz, rating double, mandate_date timestamp_ntz, mandate_delta_days long",
    )
    return base, labels


def _features(spark, base, labels):
    cw = CA.call_window(base, labels, CFG, checkpoint=False)
    return CA.call_features_raw(cw, CFG, checkpoint=False).collect()


def test_skew_split_same_result(spark):
    base, labels = _base(spark)
    keys = {
        "spark.sql.adaptive.skewJoin.enabled": None,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": None,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": None,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": None,
        "spark.sql.autoBroadcastJoinThreshold": None,
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # keep the shuffle join
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        plain = sorted(map(tuple, _features(spark, base, labels)))
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
        split = sorted(map(tuple, _features(spark, base, labels)))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(plain) > 0 and plain == split
