"""Daily alert list: latest recent score of each still-open opportunity, least satisfied
first, without opportunities already alerted in the last days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.config import Config
from callpulse.functions.timefns import floor_days


def latest_scores(scores: DataFrame, opps: DataFrame, cfg: Config) -> DataFrame:
    """Newest score per open opportunity, scores at most ``alert_max_age_days`` old; proba as a rounded percent."""
    # calendar age <= max_age days, written on the bare column so it reaches the scan of the growing score table
    since = F.date_sub(F.lit(cfg.as_of), cfg.alert_max_age_days).cast("timestamp_ntz")
    s = scores.where(F.col("date_pred") >= since).select("opp_id", "date_pred", "url", "proba")
    o = opps.select("opp_id", "lost_reason", "lost_at", "funds_at", "stage", "is_pro", "lead_owner")
    j = s.join(o, "opp_id", "left").where(
        F.col("lost_reason").isNull()
        & F.col("lost_at").isNull()
        & F.col("funds_at").isNull()
        & ~F.col("stage").isin(*cfg.closed_stages)
        & (F.col("is_pro") != F.lit(True))
        & ~F.col("lead_owner").isin(*cfg.alert_excluded_lead_owners)
    )
    # newest first; among same-day scores the highest proba (total order, map-side combined)
    top = j.groupBy("opp_id").agg(
        F.max_by(F.struct("date_pred", "url", "proba"), F.struct("date_pred", "proba", "url")).alias("_p")
    )
    return top.select(
        F.col("_p.date_pred").alias("date_pred"),
        "opp_id",
        F.col("_p.url").alias("url"),
        F.round(F.lit(100.0) * F.col("_p.proba")).alias("proba"),
    )


def alerts_ranked(scores: DataFrame, opps: DataFrame, cfg: Config) -> DataFrame:
    """Latest scores ordered from the least satisfied."""
    return latest_scores(scores, opps, cfg).orderBy(F.col("proba").asc(), F.col("opp_id").asc())


def handled(previous: DataFrame) -> DataFrame:
    """Previous-day alerts that carry a handling mark."""
    t = F.col("treatment")
    return previous.where(t.isNotNull() & (t != ""))


def merge_history(history: DataFrame, previous: DataFrame) -> DataFrame:
    """History plus the handled alerts of the previous day (bag union by column name)."""
    return history.unionByName(handled(previous), allowMissingColumns=True)


def new_alerts(latest: DataFrame, history: DataFrame, cfg: Config) -> DataFrame:
    """Latest alerts minus opportunities alerted less than ``alert_recent_days`` before the newest alert."""
    newest = latest.select(F.max("date_pred")).scalar()
    recent = history.where(floor_days(newest, F.col("date_pred")) < cfg.alert_recent_days).select("opp_id")
    out = latest.join(recent, "opp_id", "left_anti")
    out = out.withColumn("treatment", F.lit("")).select("date_pred", "opp_id", "url", "proba", "treatment")
    # least satisfied first; sorted here, as a join above a sort need not keep it
    return out.orderBy(F.col("proba").asc(), F.col("opp_id").asc())


def cleared_previous(previous: DataFrame) -> DataFrame:
    """Previous-day list with the handling marks emptied once they were merged."""
    return previous.withColumn("treatment", F.lit(""))
