"""Score table, alert versions, stored calls and the tolerant reader."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from callpulse.config import Config
from callpulse.functions.timefns import parse_utc
from callpulse.operators import storage as ST
from callpulse.plans import jobs
from callpulse.session import materialize, scratch_tables
from callpulse.sources.tables import SCORE_SCHEMA, read_reviews_csv, read_reviews_tolerant

SF = "/root/testdata/sf0.001"
D = dt.datetime


def _scores(spark, *rows):
    full = [(a, a * 10, p, None, None, None, None, None, None, "", "u", d) for a, p, d in rows]
    return spark.createDataFrame(full, SCORE_SCHEMA)


def test_a_retried_run_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "scores")
    assert ST.read_scores(spark, path).count() == 0
    ST.append_scores(_scores(spark, (1, 0.1, D(2024, 1, 1)), (2, 0.2, D(2024, 1, 1))), path, run="2024-01-01")
    ST.append_scores(_scores(spark, (3, 0.3, D(2024, 1, 2))), path, run="2024-01-02")
    ST.append_scores(_scores(spark, (1, 0.9, D(2024, 1, 1))), path, run="2024-01-01")
    got = {(r.account_id, r.proba) for r in ST.read_scores(spark, path).collect()}
    assert got == {(1, 0.9), (3, 0.3)}
    for _ in range(2):  # without a name every call appends
        ST.append_scores(_scores(spark, (7, 0.7, D(2024, 1, 3, 5))), path)
    assert ST.read_scores(spark, path).where("account_id = 7").count() == 2
    assert ST.read_scores(spark, path).schema == SCORE_SCHEMA


def test_a_run_that_fails_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "scores")
    ST.append_scores(_scores(spark, (1, 0.1, D(2024, 1, 1))), path, run="a")
    publish = ST.Commits.publish

    def fail(*_):
        raise RuntimeError("lost between write and commit")

    monkeypatch.setattr(ST.Commits, "publish", fail)
    for run in ("a", "b"):
        with pytest.raises(RuntimeError):
            ST.append_scores(_scores(spark, (2, 0.2, D(2024, 1, 1))), path, run=run)
    assert [r.account_id for r in ST.read_scores(spark, path).collect()] == [1]
    monkeypatch.setattr(ST.Commits, "publish", publish)
    ST.append_scores(_scores(spark, (2, 0.2, D(2024, 1, 1))), path, run="a")
    assert [r.account_id for r in ST.read_scores(spark, path).collect()] == [2]


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    path = str(tmp_path / "scores")
    ST.append_scores(_scores(spark, (1, 0.1, D(2024, 1, 1))), path, run="a")
    before = ST.read_scores(spark, path)
    ST.append_scores(_scores(spark, (2, 0.2, D(2024, 1, 1))), path, run="a")
    assert [r.account_id for r in before.collect()] == [1]
    assert [r.account_id for r in ST.read_scores(spark, path).collect()] == [2]


def test_score_days_are_pruned(spark, tmp_path):
    path = str(tmp_path / "scores")
    ST.append_scores(_scores(spark, *[(i, 0.5, D(2024, 1, 1) + dt.timedelta(days=i)) for i in range(20)]), path)
    recent = ST.read_scores(spark, path, dt.date(2024, 1, 19))
    assert sorted(r.account_id for r in recent.collect()) == [18, 19]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "pred_day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_calls_by_month_are_pruned_by_the_labels(spark, tmp_path):
    path = str(tmp_path / "calls")
    calls = spark.createDataFrame([(i, D(2023, 1, 1) + dt.timedelta(days=i, hours=i % 24)) for i in range(700)], "call_id long, start_time timestamp_ntz")
    ST.write_calls(calls, path)
    ST.write_calls(calls.where(F.col("start_time") < F.lit("2023-03-01").cast("timestamp_ntz")), path)  # two months again
    assert ST.read_calls(spark, path).count() == 700
    cfg = Config()
    labels = spark.createDataFrame([(D(2024, 3, 10),), (D(2024, 4, 2),)], "ref_date timestamp_ntz")
    got = ST.read_calls(spark, path, labels, cfg)
    months = {(r.start_time.year, r.start_time.month) for r in got.collect()}
    assert months == {(2024, 1), (2024, 2), (2024, 3), (2024, 4)}
    assert "PartitionFilters" in got._jdf.queryExecution().executedPlan().toString()


def test_alert_versions(spark, tmp_path, monkeypatch):
    out, day = str(tmp_path / "out"), Config().as_of
    first = jobs.alerts_job(spark, SF, out).collect()
    old = jobs.current_alerts(spark, out, day, "alert_history")
    n = old.count()
    # a failed run leaves the day's version as it was
    monkeypatch.setattr(ST.Commits, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.alerts_job(spark, SF, out)
    monkeypatch.undo()
    assert jobs.current_alerts(spark, out, day).collect() == first
    # a repeated day is a new version; the old one stays readable
    again = jobs.alerts_job(spark, SF, out).collect()
    assert again == first and old.count() == n
    assert jobs.current_alerts(spark, out, day).inputFiles() != old.inputFiles()
    # the next day reads the newest version of the day before
    second = jobs.alerts_job(spark, SF, out, as_of=day + dt.timedelta(days=1))
    assert second.count() >= 0
    assert jobs.current_alerts(spark, out, day + dt.timedelta(days=1), "alert_history").count() >= n


def test_scratch_tables_go_with_their_job(spark):
    with scratch_tables(spark):
        kept = materialize(spark.range(5))
        path = kept.inputFiles()[0]
        assert kept.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_tolerant_review_reader(spark, tmp_path):
    path = tmp_path / "reviews"
    path.mkdir()
    lines = [
        "opp_id,account_id,review_ts,rating,review_id",
        "1,2,2024-01-05T10:00:00+02:00,4.0,10",
        "1,2,2024-01-05 08:00:00,,11",
        "1,2,2024-01-05,3.5,12",
        "1,2,soon,5,13",
        "1,2,2024-02-30,5,14",
        "1,2,,5,15",
        "1,two,2024-01-05,5,16",
        "1,2,2024-01-05T08:00:00Z,great,17",
        "1,2,2024-01-05,5",
        "1,2,2024-01-05T08:00:00Z,5,18,too,many",
    ]
    (path / "a.csv").write_text("\n".join(lines) + "\n")
    good, bad = read_reviews_tolerant(spark, str(path))
    ts = {r.review_id: r.review_ts for r in good.collect()}
    at = D(2024, 1, 5, 8)
    assert ts == {10: at, 11: at, 12: D(2024, 1, 5), 13: None, 14: None, 15: None}
    assert sorted(r.bad_row for r in bad.collect()) == sorted(lines[7:11])
    assert read_reviews_csv(spark, str(path)).count() == 6


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-06-01 12:00:00",), ("2024-06-01T12:00:00-05:00",), ("2024-06-01",), ("x",), (None,)], "t string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(parse_utc("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [D(2024, 6, 1, 12), D(2024, 6, 1, 17), D(2024, 6, 1), None, None]
