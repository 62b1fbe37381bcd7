"""Builders for hand-made micro frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

CW_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("opp_id", T.LongType()),
        T.StructField("ref_date", T.TimestampNTZType()),
        T.StructField("call_id", T.LongType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("direction", T.StringType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("agent", T.StringType()),
        T.StructField("agent_norm", T.StringType()),
        T.StructField("role_id", T.StringType()),
        T.StructField("manager_name", T.StringType()),
        T.StructField("missed_status", T.StringType()),
        T.StructField("absence_flag", T.StringType()),
        T.StructField("no_show", T.LongType()),
        T.StructField("on_time", T.LongType()),
        T.StructField("late_lt5", T.LongType()),
        T.StructField("late_lt15", T.LongType()),
        T.StructField("late_ge_15", T.LongType()),
        T.StructField("first_expert_call", T.TimestampNTZType()),
        T.StructField("mandate_date", T.TimestampNTZType()),
    ]
)

REF = dt.datetime(2024, 3, 1)


def call(
    call_id,
    start,
    direction="in",
    duration=30.0,
    agent="Ana",
    account=1,
    opp=10,
    ref=REF,
    role="EXPERT",
    manager="M1",
    missed=None,
    absence="work",
    punct=(1, 1, 1, 1, 0),
    first_expert=dt.datetime(2023, 1, 1),
):
    norm = agent.lower() if agent is not None else None
    return (
        account,
        opp,
        ref,
        call_id,
        start,
        direction,
        duration,
        agent,
        norm,
        role,
        manager,
        missed,
        absence,
        *punct,
        first_expert,
        dt.datetime(2024, 1, 1),
    )


def cw(spark, rows):
    return spark.createDataFrame(rows, CW_SCHEMA)
