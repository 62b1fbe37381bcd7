"""Warehouse extracts: the relational queries that feed the feature steps.

* ``missed_status`` - one row per (account, opportunity, day) with a missed
  inbound call, labelled by whether a short call happened the same day.
  One grouped aggregation instead of the self-join of the original query.
* ``scheduled_slots`` / ``realised_calls`` / ``punctuality`` - appointment
  punctuality counts, per agent (training query) or per account (scoring).
* ``call_base`` - the call register joined to its opportunity, user,
  missed-day status, punctuality and absence.
* ``opps_train`` / ``opps_open`` / ``mandates_train`` / ``mandates_open``.

Inputs are the domain tables of ``callpulse.sources.adapters`` (or real
tables with the same columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callpulse.config import MISSED_NO_CALLBACK, MISSED_SAME_DAY, Config
from callpulse.functions.timefns import minutes_between

# LIKE patterns that mark a CRM task as a realised call.
TASK_ANY_PATTERNS = ("%inbound%", "%outbound%")
TASK_ALL_PATTERNS = ("%appel%", "%démarr%")
TASK_EXPERT_PATTERN = "%missed%"

ABSENT = "absent"
WORK = "work"


def calls_with_opps(calls: DataFrame, opps: DataFrame) -> DataFrame:
    """Calls joined to their opportunity through the project key (inner)."""
    o = opps.select("project_id", "opp_id", "account_id", "record_type_id")
    return calls.join(o, "project_id")


def missed_status(calls_opp: DataFrame, cfg: Config) -> DataFrame:
    """(account_id, opp_id, call_day, missed_status) for days with a missed inbound call.

    A day is ``no_callback`` when no call of that day (either direction) is
    shorter than ``callback_below_s``, else ``same_day_callback``.
    """
    g = calls_opp.groupBy("account_id", "opp_id", F.to_date("start_time").alias("call_day")).agg(
        F.bool_or(missed_call(cfg)).alias("has_missed"),
        F.count_if(F.col("duration_s") < cfg.callback_below_s).alias("n_short"),
    )
    return g.where("has_missed").select(
        "account_id", "opp_id", "call_day", status_of(F.col("has_missed"), F.col("n_short")).alias("missed_status")
    )


def _owner_users(users: DataFrame) -> DataFrame:
    return users.select(F.col("user_id").alias("owner_id"), F.col("name").alias("expert_name"), "role_id")


def scheduled_slots(appointments: DataFrame, users: DataFrame, cfg: Config, by: str = "agent") -> DataFrame:
    """First confirmed phone appointment per (account, owner, expert, day) or per (account, day)."""
    a = appointments.join(_owner_users(users), "owner_id", "left")
    cond = (
        (F.col("is_deleted") == F.lit(False))
        & F.lower("status").like(cfg.schedule_status_like)
        & (F.col("type") == cfg.schedule_type)
        & F.col("subject").like(cfg.schedule_subject_like)
    )
    if by == "account":
        cond = cond & F.col("role_id").isin(*cfg.expert_roles)
        keys = ["account_id", F.to_date("start_at").alias("slot_day")]
    else:
        keys = ["account_id", "owner_id", "expert_name", F.to_date("start_at").alias("slot_day")]
    return a.where(cond).groupBy(*keys).agg(F.min("start_at").alias("slot_at"))


def realised_calls(tasks: DataFrame, opps: DataFrame, users: DataFrame, cfg: Config, by: str = "agent") -> DataFrame:
    """First logged call per (account, day, expert) or per (account, day)."""
    t = tasks.join(opps.select("opp_id", "account_id"), "opp_id", "left").join(_owner_users(users), "owner_id", "left")
    subj = F.lower("subject")
    cond = subj.like(TASK_ANY_PATTERNS[0])
    for p in TASK_ANY_PATTERNS[1:]:
        cond = cond | subj.like(p)
    both = subj.like(TASK_ALL_PATTERNS[0])
    for p in TASK_ALL_PATTERNS[1:]:
        both = both & subj.like(p)
    # the role test binds to the last alternative only
    cond = cond | both | (subj.like(TASK_EXPERT_PATTERN) & F.col("role_id").isin(*cfg.expert_roles))
    keys = ["account_id", F.to_date("created_at").alias("call_day")]
    if by != "account":
        keys.append("expert_name")
    return t.where(cond).groupBy(*keys).agg(F.min("created_at").alias("first_call_at"))


def punctuality(slots: DataFrame, realised: DataFrame, by: str = "agent") -> DataFrame:
    """No-show and lateness counts; the ``< n`` minute bins are cumulative.

    Slots join realised calls on (account, day) only, as in the source query,
    so several owners or experts on one account-day multiply the pairs.
    """
    r = realised.select("account_id", F.col("call_day").alias("slot_day"), "first_call_at")
    j = slots.join(r, ["account_id", "slot_day"], "left")
    m = minutes_between("slot_at", "first_call_at")
    group = "expert_name" if by != "account" else "account_id"
    return j.groupBy(group).agg(
        F.count_if(F.col("first_call_at").isNull()).alias("no_show"),
        F.count_if(m < 1).alias("on_time"),
        F.count_if(m < 5).alias("late_lt5"),
        F.count_if(m < 15).alias("late_lt15"),
        F.count_if(m >= 15).alias("late_ge_15"),
    )


PUNCTUALITY_COLUMNS = ("no_show", "on_time", "late_lt5", "late_lt15", "late_ge_15")


def missed_call(cfg: Config):
    """Inbound call that was not really answered."""
    d = F.col("duration_s")
    return F.coalesce((F.col("direction") == "in") & ((d < cfg.missed_below_s) | d.isNull()), F.lit(False))


def status_of(has_missed, n_short):
    """Status of a day: null without a missed call."""
    return F.when(has_missed, F.when(n_short == 0, F.lit(MISSED_NO_CALLBACK)).otherwise(F.lit(MISSED_SAME_DAY)))


def _day_status(cfg: Config):
    """Missed status of the call's (account, opportunity, day); a group is one opportunity's day of calls."""
    day = Window.partitionBy("account_id", "opp_id", "call_day")
    known = F.col("account_id").isNotNull() & F.col("opp_id").isNotNull() & F.col("call_day").isNotNull()
    n_short = F.sum(F.when(F.col("duration_s") < cfg.callback_below_s, 1).otherwise(0)).over(day)
    return F.when(known, status_of(F.max(missed_call(cfg)).over(day), n_short))


def spread_nulls(key: str, row_id: str):
    """A text join key whose nulls match nothing and are dealt out by the row's id, instead of all going to one task."""
    return F.coalesce(F.col(key), F.concat(F.lit("\0"), F.col(row_id).cast("string")))


def call_base(
    calls: DataFrame,
    opps: DataFrame,
    users: DataFrame,
    absences: DataFrame,
    appointments: DataFrame,
    tasks: DataFrame,
    cfg: Config,
    by: str = "agent",
    missed: bool = True,
) -> DataFrame:
    """Call register with opportunity, user role, missed-day status, punctuality and absence flag.

    ``missed=False`` leaves the missed-day status out, for steps that derive it from day cells.
    """
    b = calls_with_opps(calls, opps).withColumn("call_day", F.to_date("start_time"))
    if missed:
        b = b.withColumn("missed_status", _day_status(cfg))
    u = users.select("user_id", F.col("name").alias("expert_name"), F.col("email").alias("_email"), "role_id")
    p = punctuality(scheduled_slots(appointments, users, cfg, by), realised_calls(tasks, opps, users, cfg, by), by)
    if by != "account":
        u = u.join(p, "expert_name", "left")  # the users get their punctuality, so that calls meet both in one join
    b = b.join(u, spread_nulls("users_email", "call_id") == u["_email"], "left").drop("_email")
    if by == "account":
        b = b.join(p, "account_id", "left")
    ab = absences.select("user_id", F.col("absent_on").alias("call_day"), F.lit(True).alias("_absent"))
    b = b.join(ab, ["user_id", "call_day"], "left")
    b = b.where(
        F.col("opp_id").isNotNull() & F.col("account_id").isNotNull() & (F.col("record_type_id") == cfg.main_record_type)
    )
    return b.select(
        "call_id",
        "opp_id",
        "account_id",
        "direction",
        "start_time",
        "duration_s",
        "agent",
        "expert_name",
        "manager_name",
        "role_id",
        *(["missed_status"] if missed else []),
        *PUNCTUALITY_COLUMNS,
        F.when(F.col("_absent"), F.lit(ABSENT)).otherwise(F.lit(WORK)).alias("absence_flag"),
    )


def _signed(opps: DataFrame, stages: DataFrame, users: DataFrame, cfg: Config) -> DataFrame:
    u = users.select(F.col("user_id").alias("owner_id"), F.col("name").alias("owner_name"))
    # stages last: what joins by opportunity afterwards finds the rows where they are
    o = opps.join(u, "owner_id", "left").join(stages, "opp_id", "left")
    comp = F.col("compromise_at")
    bad = (F.to_date(comp) > F.lit(cfg.as_of)) | (comp < F.lit(cfg.compromise_min_date).cast("timestamp_ntz"))
    o = o.where(F.col("mandate_signed_at").isNotNull() & (F.col("record_type_id") == cfg.main_record_type))
    return o.withColumn("compromise_at", F.when(bad, F.lit(None).cast("timestamp_ntz")).otherwise(comp))


def opps_train(opps: DataFrame, stages: DataFrame, users: DataFrame, cfg: Config) -> DataFrame:
    """Opportunities with a signed mandate, main record type; implausible compromise dates nulled."""
    return _signed(opps, stages, users, cfg).select(*OPP_COLUMNS)


OPP_COLUMNS = (
    "opp_id",
    "account_id",
    "created_at",
    "mandate_signed_at",
    "stage",
    "channel",
    "owner_name",
    "record_type_id",
    "compromise_at",
    "suspensive_at",
    "lost_at",
    "offer_edited_at",
    "funds_at",
    "to_reach_at",
    "r1_at",
    "search_no_docs_at",
    "search_docs_at",
    "assembly_at",
    "sent_at",
)


def opps_open(opps: DataFrame, stages: DataFrame, users: DataFrame, reassignments: DataFrame, cfg: Config) -> DataFrame:
    """Open opportunities of the scoring query, with the account's reassignment count.

    ``NOT IN`` filters drop rows whose value is null, as in SQL.
    """
    o = _signed(opps, stages, users, cfg)
    r = reassignments.select("account_id", F.col("cnt").alias("n_reassignments"))
    o = o.join(r, "account_id", "left")
    o = o.where(
        (F.col("is_closed") == F.lit(False))
        & ~F.col("stage").isin(*cfg.closed_stages)
        & ~F.col("owner_name").isin(*cfg.excluded_owner_names)
        & (F.col("visio") == F.lit(False))
    )
    return o.select(*OPP_COLUMNS, "lost_reason", "n_reassignments")


def mandates_train(mandate_events: DataFrame, bank_requests: DataFrame) -> DataFrame:
    """Mandate approvals with their opportunity when the project has one: (received_at, opp_id)."""
    return mandate_events.join(bank_requests, "project_id", "left").select("received_at", "opp_id")


def mandates_open(opps: DataFrame, cfg: Config) -> DataFrame:
    """Signed, unfunded, open opportunities of the scored lead owner: (opp_id, account_id, mandate_at)."""
    o = opps.where(
        F.col("mandate_signed_at").isNotNull()
        & F.col("funds_at").isNull()
        & (F.col("is_closed") == F.lit(False))
        & ~F.col("stage").isin(*cfg.closed_stages)
        & (F.col("lead_owner") == cfg.scoring_lead_owner)
    )
    return o.select("opp_id", "account_id", F.col("mandate_signed_at").alias("mandate_at"))
