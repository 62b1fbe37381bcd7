"""Batch job wiring: outputs land where expected and read back with the declared schema."""

from __future__ import annotations

import tempfile

from callpulse.plans.jobs import alerts_job
from callpulse.sources.tables import ALERT_SCHEMA

SF = "/root/testdata/sf0.01"


def test_alerts_job_chain_of_two_days(spark):
    from datetime import timedelta

    from callpulse.config import Config

    out = tempfile.mkdtemp(prefix="callpulse-alerts-")
    day = Config().as_of
    new = alerts_job(spark, SF, out)
    first = f"{out}/alerts/{day}"
    rows = spark.read.schema(ALERT_SCHEMA).parquet(f"{first}/new_alerts").collect()
    assert len(rows) == new.count() > 0
    assert [(r.proba, r.opp_id) for r in rows] == sorted((r.proba, r.opp_id) for r in rows)
    hist = spark.read.parquet(f"{first}/alert_history").count()
    assert hist > 0
    assert spark.read.parquet(f"{first}/previous_alerts_cleared").where("treatment <> ''").count() == 0
    # mark one alert as handled, as a user of the list does, then run the next day
    spark.read.schema(ALERT_SCHEMA).parquet(f"{first}/new_alerts").selectExpr(
        "date_pred", "opp_id", "url", "proba", f"if(opp_id = {rows[0].opp_id}, 'done', '') AS treatment"
    ).write.parquet(f"{out}/marked")
    spark.read.parquet(f"{out}/marked").write.mode("overwrite").parquet(f"{first}/new_alerts")
    second = alerts_job(spark, SF, out, as_of=day + timedelta(days=1))
    assert spark.read.parquet(f"{out}/alerts/{day + timedelta(days=1)}/alert_history").count() == hist + 1
    assert rows[0].opp_id not in {r.opp_id for r in second.collect()}


def test_train_then_score_job_writes_outputs(spark):
    from callpulse.config import Config
    from callpulse.plans.jobs import score_job, train_job
    from callpulse.sources.tables import SCORE_SCHEMA

    cfg = Config(num_trees=5, min_instances_per_node=5)
    root = tempfile.mkdtemp(prefix="callpulse-jobs-")
    metrics = train_job(spark, SF, f"{root}/model", cfg)
    assert metrics.first()["n_train"] > 0
    scores = score_job(spark, SF, f"{root}/model", root, cfg=cfg)
    n = scores.count()
    table = spark.read.schema(SCORE_SCHEMA).parquet(f"{root}/score_table")
    assert table.count() == n > 0
    latest = spark.read.schema(SCORE_SCHEMA).option("header", True).csv(f"{root}/predictions_latest")
    assert latest.count() == n
    by_day = spark.read.option("header", True).csv(f"{root}/predictions_by_day")
    assert by_day.select("pred_day").distinct().count() == 1
    # a second run of the same day appends to the table and replaces only that day's copy
    score_job(spark, SF, f"{root}/model", root, cfg=cfg)
    assert spark.read.schema(SCORE_SCHEMA).parquet(f"{root}/score_table").count() == 2 * n
    assert spark.read.option("header", True).csv(f"{root}/predictions_by_day").count() == n
