"""CRM cleaning and stage-delay features at the label grain.

Cleaning steps run in a fixed order and each reads the result of the
previous one (chained ``withColumn``), because the order changes results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callpulse.config import CRM_DATE_COLUMNS, STAGE_COLUMNS, Config
from callpulse.functions.timefns import add_days, floor_days

def _null_if(col: str, cond) -> F.Column:
    return F.when(cond, F.lit(None).cast("timestamp_ntz")).otherwise(F.col(col))


def crm_clean(opps: DataFrame, labels: DataFrame, cfg: Config, train: bool = True) -> DataFrame:
    """Opportunities matched to labels, masked at the reference date and made consistent."""
    lab = labels.select("opp_id", "account_id", "ref_date", "rating", "mandate_date", "mandate_delta_days")
    lab = lab.withColumnsRenamed({"opp_id": "_opp", "account_id": "_acc"})
    # the account is no key of the join: by the opportunity alone, opportunities joined to their stages need no other shuffle
    same_account = (opps["account_id"] <= lab["_acc"]) & (opps["account_id"] >= lab["_acc"])
    x = opps.join(lab, (opps["opp_id"] == lab["_opp"]) & same_account).drop("_opp", "_acc")
    ref = F.col("ref_date")
    # point in time: nothing after the reference date is known
    x = x.withColumns({c: _null_if(c, F.col(c) > ref) for c in CRM_DATE_COLUMNS})
    x = x.where(ref > F.col("created_at"))
    comp, susp = F.col("compromise_at"), F.col("suspensive_at")
    x = x.withColumn("suspensive_at", _null_if("suspensive_at", susp < F.col("created_at")))
    x = x.withColumn("compromise_at", _null_if("compromise_at", F.col("lost_at") < comp))
    x = x.withColumn("compromise_at", _null_if("compromise_at", (susp < comp) & (F.col("sent_at") < comp)))
    x = x.withColumn("suspensive_at", _null_if("suspensive_at", floor_days(susp, comp) > cfg.suspensive_max_days))
    x = x.withColumn(
        "suspensive_at",
        F.when(susp.isNull() & comp.isNotNull(), add_days(comp, cfg.suspensive_fill_days)).otherwise(susp),
    )
    x = x.withColumn(
        "compromise_at",
        F.when(comp.isNull() & susp.isNotNull(), add_days(susp, -cfg.suspensive_fill_days)).otherwise(comp),
    )
    if train:
        lost = F.col("lost_at")
        early = F.lit(False)
        for s in STAGE_COLUMNS:
            early = early | F.coalesce(floor_days(lost, s) < cfg.lost_before_stage_days, F.lit(False))
        x = x.withColumn("lost_at", _null_if("lost_at", early))
    return x


def crm_features(clean: DataFrame) -> DataFrame:
    """Stage delays, last stage reached before the reference date and its name."""
    last = F.greatest(*[F.col(c) for c in STAGE_COLUMNS])
    name = F.lit("")
    for c in STAGE_COLUMNS:  # later stage wins ties
        name = F.when(last == F.col(c), F.lit(c)).otherwise(name)
    ref = "ref_date"
    return clean.withColumns(
        {
            "days_r1_to_assembly": floor_days("assembly_at", "r1_at"),
            "days_assembly_to_sent": floor_days("sent_at", "assembly_at"),
            "last_stage_at": last,
            "last_stage": name,
        }
    ).withColumns(
        {
            "days_last_stage_to_ref": floor_days(ref, "last_stage_at"),
            "days_suspensive_to_ref": floor_days(ref, "suspensive_at"),
            "days_created_to_sent": floor_days("sent_at", "created_at"),
            "days_created_to_mandate": floor_days("mandate_date", "created_at"),
            "days_mandate_to_ref": floor_days(ref, "mandate_date"),
            "days_sent_to_ref": floor_days(ref, "sent_at"),
        }
    )
