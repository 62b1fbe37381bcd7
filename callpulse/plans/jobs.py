"""The three batch jobs: train (twice a month), score (daily), alerts (after scoring).

Each job writes its outputs under one folder on shared storage; the alerts job reads
what the score job and its own last run wrote there. Intermediate tables go when a job ends.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import SparkSession

from callpulse.config import Config
from callpulse.operators import alerts as AL
from callpulse.operators import ml as ML
from callpulse.operators import sinks as SK
from callpulse.operators import storage as ST
from callpulse.plans.catalog import Ctx
from callpulse.session import materialize, scratch_tables
from callpulse.sources import adapters as A
from callpulse.sources.tables import ALERT_SCHEMA, SCORE_SCHEMA


def train_job(spark: SparkSession, sf_dir: str, model_path: str, cfg: Config | None = None):
    """Labels from reviews, features, fit, persist; returns the metrics frame."""
    with scratch_tables(spark):
        ctx = Ctx(spark, sf_dir, cfg)
        model, metrics = ML.train(ctx.matrix, ctx.cfg)
        SK.save_model(spark, model, model_path)
        return spark.createDataFrame(metrics.collect(), metrics.schema)  # one row


def score_job(spark: SparkSession, sf_dir: str, model_path: str, out_root: str, as_of: dt.date | None = None,
              cfg: Config | None = None, mode: str = "append"):
    """Score open opportunities at ``as_of``; add to the score table and write the CSV copies.

    ``mode="append"`` adds the rows of every run; ``mode="replace"`` names the run by its date, so that a retried run
    replaces its own rows.
    """
    if mode not in ("append", "replace"):
        raise ValueError(mode)
    cfg = cfg or Config()
    if as_of:
        cfg = replace(cfg, as_of=as_of)
    with scratch_tables(spark):
        ctx = Ctx(spark, sf_dir, cfg)
        # written once; the table and both copies are derived from it
        scores = materialize(ML.score_output(SK.load_model(spark, model_path), ML.scoring_matrix(ctx, cfg), cfg))
        ST.append_scores(scores, f"{out_root}/score_table", run=str(cfg.as_of) if mode == "replace" else None)
        SK.write_scores_csv(scores, f"{out_root}/predictions_latest", f"{out_root}/predictions_by_day")
    day = spark.read.schema(SCORE_SCHEMA).option("header", True).csv(f"{out_root}/predictions_latest")
    return day


def alerts_job(spark: SparkSession, sf_dir: str, out_root: str, as_of: dt.date | None = None, cfg: Config | None = None):
    """New alerts of the day and the merged history.

    Reads the score table that ``score_job`` appends to under ``out_root``, and the
    history and alerts of the newest earlier day; before the first run, the
    derived tables. All tables of a run are a new version (the run date; when repeated, with a number), which one commit
    makes the day's current one: readers keep the old version, and a failed run changes nothing.
    """
    cfg = cfg or Config()
    if as_of:
        cfg = replace(cfg, as_of=as_of)
    t = Ctx(spark, sf_dir, cfg)
    table, alerts = f"{out_root}/score_table", f"{out_root}/alerts"
    since = cfg.as_of - dt.timedelta(days=cfg.alert_max_age_days)
    scores = ST.read_scores(spark, table, since) if _exists(spark, table) else A.scores(t.t)
    log = ST.Commits(spark, alerts)
    days = {day: version for day, version in sorted(log.current().items()) if day < str(cfg.as_of)}
    if days:
        last = f"{alerts}/{days[max(days)]}"
        history = spark.read.schema(ALERT_SCHEMA).parquet(f"{last}/alert_history")
        previous = spark.read.schema(ALERT_SCHEMA).parquet(f"{last}/new_alerts")
    else:
        history, previous = A.alert_history(t.t), A.previous_alerts(t.t)
    history = AL.merge_history(history, previous)
    new = AL.new_alerts(AL.latest_scores(scores, t.opps, cfg), history, cfg)
    version = _free(spark, alerts, str(cfg.as_of))
    SK.write_alerts(history, f"{alerts}/{version}/alert_history", sort_desc=True)
    SK.write_alerts(new, f"{alerts}/{version}/new_alerts", sort_desc=False)
    SK.write_alerts(AL.cleared_previous(previous), f"{alerts}/{version}/previous_alerts_cleared")
    log.publish(str(cfg.as_of), version)
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{alerts}/{version}/new_alerts")


def current_alerts(spark: SparkSession, out_root: str, as_of: dt.date, table: str = "new_alerts"):
    """One of the alert tables (``new_alerts``, ``alert_history``, ``previous_alerts_cleared``) of a day's newest version."""
    version = ST.Commits(spark, f"{out_root}/alerts").current()[str(as_of)]
    return spark.read.schema(ALERT_SCHEMA).parquet(f"{out_root}/alerts/{version}/{table}")


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _folder(spark, path)
    return fs.exists(p)


def _free(spark: SparkSession, path: str, name: str) -> str:
    """``name``, or the first of name-2, name-3, .. that is no folder yet."""
    version, k = name, 1
    while _exists(spark, f"{path}/{version}"):
        k += 1
        version = f"{name}-{k}"
    return version
