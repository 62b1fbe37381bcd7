"""Label-free day cells against the per-call path, on random calls with hot accounts, midnights and repeated labels."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from callpulse.config import KEY, Config
from callpulse.functions.text import fold_text
from callpulse.operators import assemble as AS
from callpulse.operators import calls as CA
from callpulse.operators import cells as CE
from callpulse.operators import warehouse as WH

CFG = Config()
D = dt.datetime
REGISTER = (
    "call_id long, opp_id long, account_id long, direction string, start_time timestamp_ntz, duration_s double, agent string, "
    "expert_name string, manager_name string, role_id string, no_show long, on_time long, late_lt5 long, late_lt15 long, late_ge_15 long, absence_flag string"
)
LABELS = "opp_id long, account_id long, ref_date timestamp_ntz, rating double, mandate_date timestamp_ntz, mandate_delta_days long"


def _calls(n=900, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        acc = 0 if rnd.random() < 0.5 else rnd.randint(1, 12)  # account 0 holds half of the calls
        start = D(2023, 11, 1) + dt.timedelta(days=rnd.randint(0, 130), seconds=rnd.choice([0, 0, rnd.randint(0, 86399)]))
        person = rnd.choice(["Émilie", "EMILIE", "José", "Zoë", None])
        pun = (rnd.randint(0, 3),) * 5 if person in ("Émilie", "Zoë") else (None,) * 5
        out.append(
            (
                i, acc * 10 + rnd.randint(0, 1), acc, rnd.choice(["in", "out", "out", None]), start if i % 97 else None,
                rnd.choice([None, 0.0, 4.0, 15.0, 30.0, 200.0, 700.0, 9000.0]), person, person, rnd.choice(["M", None, *CFG.excluded_managers]),
                rnd.choice(["EXPERT", "BIZDEV", "OTHER", None]), *pun, rnd.choice(["work", "absent"]),
            )
        )
    return out


def _labels(seed=2):
    rnd = random.Random(seed)
    out = []
    for acc in range(13):
        for k in range(rnd.randint(1, 4)):
            ref = D(2024, 1, 1) + dt.timedelta(days=rnd.choice([0, 7, 14, 30, 60]))
            out.append((acc * 10 + k, acc, ref, 4.5, D(2023, 12, 1) + dt.timedelta(days=k), -5))
            if rnd.random() < 0.4:  # another opportunity of the account with the same date: calls count twice
                out.append((acc * 10 + k + 5, acc, ref, 1.0, D(2023, 12, 20), -7))
    return out


def _with_status(register):
    """The register with the missed status of the day, as the per-call path wants it."""
    co = register.withColumn("call_day", F.to_date("start_time"))
    status = WH.missed_status(co, CFG)
    return co.join(status, ["account_id", "opp_id", "call_day"], "left").drop("call_day")


def _same(a, b):
    cols = a.columns
    assert set(cols) == set(b.columns)
    x = sorted(map(repr, (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in AS.as_double(a).select(*cols).collect())))
    y = sorted(map(repr, (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in AS.as_double(b).select(*cols).collect())))
    assert x == y and x


def _per_call(spark, register, labels):
    return CA.call_features_raw(CA.call_window(_with_status(register), labels, CFG, checkpoint=False), CFG, checkpoint=False)


@pytest.fixture(scope="module")
def register(spark):
    return spark.createDataFrame(_calls(), REGISTER).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(_labels(), LABELS)


def test_cells_equal_the_per_call_path(spark, register, labels):
    got = CE.features_from_cells(CE.day_cells(register, CFG), labels, CFG, checkpoint=False)
    _same(got, _per_call(spark, register, labels))


def test_cells_with_a_split_hot_account(spark, register, labels):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    want = CE.features_from_cells(CE.day_cells(register, CFG), labels, CFG, checkpoint=False).collect()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = CE.features_from_cells(CE.day_cells(register, CFG), labels, CFG, checkpoint=False).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_kept_cells_and_agents_equal_the_whole_history(spark, register, labels, tmp_path):
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    path = str(tmp_path / "cells")
    first, second = register.where(F.col("start_time") < cut), register.where(F.col("start_time") >= cut)
    CE.write_cells(CE.day_cells(first, CFG), path)
    kept = CE.agent_state(CE.day_cells(first, CFG))
    CE.write_cells(CE.day_cells(second, CFG), path)
    CE.write_cells(CE.day_cells(second, CFG), path)  # the same days again replace themselves
    agents = CE.merge_agents(kept, CE.agent_state(CE.day_cells(second, CFG)))
    whole = CE.agent_state(CE.day_cells(register, CFG))
    assert sorted(agents.collect()) == sorted(whole.collect())
    got = CE.features_from_cells(CE.read_cells(spark, path, labels, CFG), labels, CFG, agents, checkpoint=False)
    _same(got, _per_call(spark, register, labels))


def test_kept_cells_are_pruned_by_day(spark, register, labels, tmp_path):
    path = str(tmp_path / "cells")
    CE.write_cells(CE.day_cells(register, CFG), path)
    late = labels.where(F.col("ref_date") == F.lit("2024-01-01").cast("timestamp_ntz"))
    cells = CE.read_cells(spark, path, late, CFG)
    days = cells.select(F.to_date("slot").alias("d")).distinct().collect()
    assert min(d.d for d in days) >= dt.date(2023, 11, 2) and max(d.d for d in days) <= dt.date(2024, 1, 1)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or ("PartitionFilters" in plan and "subquery" in plan.lower())


def test_window_join_by_periods_equals_the_plain_condition(spark, register, labels):
    got = CA.join_windows(register, labels.select("account_id", "ref_date"), "start_time", CFG).select("call_id", "ref_date").collect()
    want = []
    for c in register.collect():
        for x in labels.collect():
            if c.start_time and c.account_id == x.account_id and x.ref_date - dt.timedelta(days=CFG.window_days) < c.start_time < x.ref_date:
                want.append((c.call_id, x.ref_date))
    assert sorted(map(tuple, got)) == sorted(want)


def test_a_hot_account_does_not_meet_labels_far_in_time(spark):
    """Calls of one account over ten years, labels over ten years: candidate pairs stay near the true ones."""
    days = [(i, D(2014, 1, 1) + dt.timedelta(days=i)) for i in range(3650)]
    calls = spark.createDataFrame([(1, i, t) for i, t in days], "account_id long, call_id long, start_time timestamp_ntz")
    labels = spark.createDataFrame([(1, t) for i, t in days if i % 30 == 0], "account_id long, ref_date timestamp_ntz")
    n_true = CA.join_windows(calls, labels, "start_time", CFG).count()
    span = CFG.window_days
    c = calls.groupBy(CA.period(F.col("start_time"), span).alias("p")).count()
    ends = F.array_distinct(F.array(CA.period(F.col("ref_date") - F.expr(f"INTERVAL {span} DAYS"), span), CA.period(F.col("ref_date"), span)))
    x = labels.select(F.explode(ends).alias("p")).groupBy("p").agg(F.count("*").alias("m"))
    met = c.join(x, "p").agg(F.sum(F.col("count") * F.col("m"))).first()[0]
    assert n_true > 7000 and met <= 2.2 * n_true  # all pairs would be 60 times as many


def test_per_call_keeps_every_row_of_a_hot_key(spark, register, labels):
    window = CA.call_window(_with_status(register), labels, CFG, checkpoint=False)
    raw = CE.features_from_cells(CE.day_cells(register, CFG), labels, CFG, checkpoint=False)
    rows = AS.per_call(window, raw)
    keys = raw.select(*KEY)
    assert rows.count() == window.join(keys, list(KEY)).count() > 0
    per_key = rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("n_rows").alias("m"))
    assert per_key.where("n <> m").count() == 0
    own = {(r.call_id, r.ref_date): r.no_show for r in window.collect()}
    assert all(own[r.call_id, r.ref_date] == r.no_show for r in rows.collect())


def test_null_join_keys_are_dealt_out(spark):
    df = spark.range(40).select(F.col("id").alias("call_id"), F.when(F.col("id") % 4 == 0, F.lit("x@y")).alias("users_email"))
    keys = df.select(WH.spread_nulls("users_email", "call_id").alias("k")).distinct().count()
    assert keys == 31
    users = spark.createDataFrame([("x@y", 1)], "email string, u int")
    joined = df.join(users, WH.spread_nulls("users_email", "call_id") == users["email"], "left")
    assert joined.where("u is not null").count() == 10 and joined.count() == 40


def test_folding_matches_unicodedata(spark):
    import unicodedata

    letters = [chr(c) for c in [*range(1, 0x3000), *range(0xF900, 0x10000, 3), *range(0x1D400, 0x1D7FF, 5), 0x1F600]]
    texts = ["".join(letters[i : i + 40]) for i in range(0, len(letters), 40)] + ["½ ﬁn ㎏ Ǆ ™ …", "Zoë ÀÉ", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3).select("i", fold_text(F.col("t")).alias("f"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for r in df.collect():
        t = texts[r.i]
        assert r.f == (None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()), r.i


def test_features_stay_by_opportunity(spark):
    """Neither slots nor features are shuffled to the labels or by reference date, also where nothing is broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        cells = CE.day_cells(spark.createDataFrame(_calls(200), REGISTER), CFG)
        out = CE.features_from_cells(cells, spark.createDataFrame(_labels(), LABELS), CFG, checkpoint=False)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if old is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    # only the dates of an account are grouped by date
    assert sum("opp_id" in s and "ref_date" in s for s in shuffles) == 0, shuffles
    assert not any("slot" in s and "agent" not in s for s in shuffles), shuffles


def test_written_register_is_read_by_cells_and_window(spark, tmp_path):
    """A query that reads the register twice derives it once."""
    from callpulse.plans.catalog import Ctx

    c = Ctx(spark, str(tmp_path))
    c.register = spark.createDataFrame(_calls(200), REGISTER)  # no table is there to derive it from
    assert c.cells.count() == CE.day_cells(c.register, CFG).count() > 0


def test_calls_meet_users_and_punctuality_in_one_join(spark):
    """The punctuality of an expert comes with the user, so calls are not shuffled by expert name."""
    T = "timestamp_ntz"
    frames = [
        spark.createDataFrame([(1, 5, D(2024, 1, 2), "in", 9.0, "A", "a@x", "M"), (2, 5, D(2024, 1, 2), "in", 9.0, "B", None, "M")], f"call_id long, project_id long, start_time {T}, direction string, duration_s double, agent string, users_email string, manager_name string"),
        spark.createDataFrame([(5, 5, 1, CFG.main_record_type)], "project_id long, opp_id long, account_id long, record_type_id string"),
        spark.createDataFrame([(7, "A", "a@x", "M", "EXPERT"), (8, None, "b@x", "M", "EXPERT")], "user_id long, name string, email string, manager_name string, role_id string"),
        spark.createDataFrame([(7, dt.date(2024, 1, 2))], "user_id long, absent_on date"),
        spark.createDataFrame([(1, 1, 7, D(2024, 1, 2, 9), "Confirmed", "Call", False, "Rendez-vous téléphonique")], f"event_id long, account_id long, owner_id long, start_at {T}, status string, type string, is_deleted boolean, subject string"),
        spark.createDataFrame([], f"task_id long, opp_id long, owner_id long, created_at {T}, subject string"),
    ]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = WH.call_base(*frames, CFG)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if old is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert {r.call_id: (r.expert_name, r.no_show, r.absence_flag) for r in out.collect()} == {1: ("A", 1, "absent"), 2: (None, None, "work")}
    assert sum("Join LeftOuter" in line and "call_id" in line for line in plan.splitlines()) == 1, plan


def test_accounts_without_calls_leave_before_their_dates_are_listed(spark, register, labels, monkeypatch):
    """Labels of accounts that never called change no feature and reach neither the lists nor the bounds of the windows."""
    idle = [(9000 + i, 900 + i % 50, D(2020, 1, 1) + dt.timedelta(days=i), 3.0, D(2019, 12, 1), -5) for i in range(200)]
    idle += [(9999, None, D(2024, 1, 8), 3.0, D(2019, 12, 1), -5)]
    more = labels.unionByName(spark.createDataFrame(idle, LABELS))
    cells, listed = CE.day_cells(register, CFG), []
    keep = CE._opp_dates
    monkeypatch.setattr(CE, "_opp_dates", lambda near, dates, cfg: listed.append(dates) or keep(near, dates, cfg))
    _same(CE.features_from_cells(cells, more, CFG), CE.features_from_cells(cells, labels, CFG))
    _same(CE.features_from_cells(cells, more, CFG, distinct_ref_dates=True), CE.features_from_cells(cells, labels, CFG, distinct_ref_dates=True))
    for with_idle, plain in (listed[:2], listed[2:]):
        assert sorted(with_idle.collect()) == sorted(plain.collect())
