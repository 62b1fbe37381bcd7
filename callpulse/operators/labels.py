"""Point-in-time labels: one row per (opportunity, reference date).

Training labels come from customer reviews matched to the mandate signature;
scoring labels use the run date as reference date for open opportunities.
Keep-first picks are ``min_by`` aggregations with a total order, which
aggregate map-side and so stay cheap even for a very hot opportunity.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.config import Config
from callpulse.functions.timefns import add_days, floor_days, round_to_day

LABEL_COLUMNS = ("opp_id", "account_id", "ref_date", "rating", "mandate_date", "mandate_delta_days")


def union_reviews(*frames: DataFrame) -> DataFrame:
    """Bag union of review sources aligned by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _keep_closest_after_mandate(df: DataFrame, tie_break: list[str]) -> DataFrame:
    """Per opportunity, the row with the largest (closest to zero) negative mandate delta."""
    payload = [c for c in df.columns if c != "opp_id"]
    order = F.struct(-F.col("mandate_delta_days"), *[F.col(c) for c in tie_break])
    picked = df.groupBy("opp_id").agg(F.min_by(F.struct(*payload), order).alias("_p"))
    return picked.select("opp_id", *[F.col("_p")[c].alias(c) for c in payload])


def labels_train(mandates: DataFrame, reviews: DataFrame, cfg: Config) -> DataFrame:
    """Review labels after the mandate, closest one per opportunity (before the shifted copies)."""
    m = mandates.select("opp_id", "received_at").distinct()
    m = m.select("opp_id", round_to_day("received_at").alias("mandate_date"))
    lower = F.lit(cfg.review_min_date).cast("timestamp_ntz")
    r = reviews.where(F.col("review_ts") > lower).select(
        "opp_id",
        "account_id",
        F.col("rating").cast("double").alias("rating"),
        "source",
        "review_id",
        "review_ts",
        round_to_day("review_ts").alias("ref_date"),
    )
    j = r.join(m, "opp_id").withColumn("mandate_delta_days", floor_days("mandate_date", "ref_date"))
    j = j.where(F.col("mandate_delta_days") < 0)
    kept = _keep_closest_after_mandate(j, ["source", "review_id", "review_ts", "rating", "mandate_date"])
    return kept.select(*LABEL_COLUMNS)


def shift_labels(labels: DataFrame, cfg: Config) -> DataFrame:
    """Augment with copies whose reference date is moved back; the mandate delta is kept as is."""
    shifts = F.array(*[F.lit(0)] + [F.lit(int(s)) for s in cfg.shift_days])
    x = labels.withColumn("_shift", F.explode(shifts))
    return x.withColumn("ref_date", add_days("ref_date", -F.col("_shift"))).drop("_shift")


def of_accounts(labels: DataFrame, accounts: DataFrame) -> DataFrame:
    """Labels (or dates) of the accounts given."""
    return labels.join(accounts.select("account_id"), "account_id", "left_semi").select(*labels.columns)


def labels_score(mandates_open: DataFrame, cfg: Config, as_of: dt.date | None = None) -> DataFrame:
    """Scoring labels: reference date = run date, rating unknown."""
    ref = F.lit(as_of or cfg.as_of).cast("timestamp_ntz")
    m = mandates_open.select("opp_id", "account_id", round_to_day("mandate_at").alias("mandate_date")).na.drop()
    m = m.withColumn("ref_date", round_to_day(ref)).withColumn("mandate_delta_days", floor_days("mandate_date", "ref_date"))
    m = m.where(F.col("mandate_delta_days") < 0)
    kept = _keep_closest_after_mandate(m, ["account_id", "mandate_date"])
    return kept.withColumn("rating", F.lit(None).cast("double")).select(*LABEL_COLUMNS)
