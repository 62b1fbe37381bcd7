"""Writers. Paths come from the caller (shared storage on a cluster)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callpulse.operators.forest import ForestModel
from callpulse.operators.storage import conform
from callpulse.sources.tables import ALERT_SCHEMA, SCORE_SCHEMA


def write_scores_csv(df: DataFrame, latest_path: str, dated_root: str) -> None:
    """Latest copy (overwritten) and a copy per prediction date (only that partition replaced)."""
    out = conform(df, SCORE_SCHEMA)
    out.write.mode("overwrite").option("header", True).csv(latest_path)
    (
        out.withColumn("pred_day", F.to_date("date_pred"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("pred_day")
        .option("header", True)
        .csv(dated_root)
    )


def save_model(spark: SparkSession, model: ForestModel, path: str) -> None:
    model.save(spark, path)


def load_model(spark: SparkSession, path: str) -> ForestModel:
    return ForestModel.load(spark, path)


def write_alerts(df: DataFrame, path: str, sort_desc: bool | None = None) -> None:
    """Alert tables are written to the folder of a new version, never over the one being read.

    ``sort_desc``: True sorts by newest date first, False by least satisfied first, None not at all.
    """
    out = conform(df, ALERT_SCHEMA)
    if sort_desc:
        out = out.orderBy(F.col("date_pred").desc())
    elif sort_desc is False:
        out = out.orderBy(F.col("proba").asc(), F.col("opp_id").asc())
    out.write.mode("overwrite").parquet(path)
