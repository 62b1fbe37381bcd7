"""Domain tables derived from the driver's synthetic parquet tables.

The library works on CRM / telephony tables (calls, opportunities, users,
appointments, tasks, absences, mandates, reviews, scores, alert history).
The test data holds TPC-H-like tables instead, so each domain table is
derived here with deterministic column rules (documented in FIXTURES.md).
The DuckDB oracle (``callpulse.plans.oracle``) repeats the same rules in SQL.

All derivations are row-wise projections, group-bys with map-side partial
aggregation, or equi-joins on a key, so they scale with the inputs. The windows that number a customer's orders
run over ranges of order keys (at most ``ORDER_RANGE`` rows) and over the counts of the ranges, not over the orders of a customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callpulse.functions.timefns import add_days, add_hours
from callpulse.sources.tables import Tables

# Fixed values of the synthetic adapters (also used by the SQL oracle).
BASE_DAY = "1995-01-01"
CREATED_BASE = "2023-11-01 00:00:00"
AGENT_FIRST_NAMES = ("Émilie", "José", "Zoë", "François", "Hélène", "Jérôme", "Anaïs", "Noël")
ROLE_CODES = ("EXPERT", "EXPERT_MANAGER", "BIZDEV", "OTHER")
STAGES = ("r1", "docs", "search", "assembly", "sent", "offer_edited", "offer_signed", "lost")
RATINGS = (1.0, 2.0, 3.0, 3.5, 4.0, 5.0)
REVIEW_SOURCES = ("trustpilot", "nps", "google_facebook")
TASK_SUBJECTS = ("Inbound call", "Outbound call", "Appel démarré", "Missed call", "Email envoyé")
APPOINTMENT_STATUSES = ("Confirmed", "Unconfirmed", "Cancelled")
SCHEDULE_SUBJECTS = ("Rendez-vous téléphonique", "Rendez-vous visio")
TREATMENTS = ("", None, "done")
URL_PREFIX = "https://crm.example.org/opportunity/"

#: order keys of a range that is numbered in one piece
ORDER_RANGE = 65_536


def _pick(values, idx: Column) -> Column:
    """``values[idx]`` for a 0-based integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _n_agents(t: Tables) -> Column:
    """Row count of ``supplier`` as a scalar subquery (evaluated once)."""
    return t.supplier.select(F.count(F.lit(1))).scalar()


def _agent_of(user_id: Column, event_id: Column, n: Column) -> Column:
    return F.pmod(user_id * 7 + event_id % 3, n)


def agents(t: Tables) -> DataFrame:
    """User dimension: (user_id, name, email, manager_name, role_id)."""
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    k = F.col("s_suppkey")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        k.alias("user_id"),
        F.concat_ws(" ", _pick(AGENT_FIRST_NAMES, k % 8), k.cast("string")).alias("name"),
        F.concat(F.lit("a"), k.cast("string"), F.lit("@x.org")).alias("email"),
        F.when(k % 6 == 5, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("manager_name"),
        _pick(ROLE_CODES, k % 4).alias("role_id"),
    )


def _events_with_project(t: Tables, where: Column | None = None) -> DataFrame:
    """Events with ``project_id``: of the customer's n orders, in key order, the one numbered event_id modulo n."""
    ev = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    if where is not None:
        ev = ev.where(where)
    # two levels: orders are numbered inside ranges of ORDER_RANGE keys, each range starts where the ones before it end
    o = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("project_id"))
    o = o.withColumn("_range", F.floor(F.col("project_id") / ORDER_RANGE))
    ranges = o.groupBy("user_id", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("user_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("user_id", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("user_id", "_range").orderBy("project_id")
    order = o.withColumn("_in", F.row_number().over(inside) - 1).join(starts, ["user_id", "_range"])
    order = order.select("user_id", (F.col("_start") + F.col("_in")).cast("bigint").alias("nth"), "project_id")
    # the key is written as an expression, so that both sides of the join come from a shuffle and a hot customer's events are split
    count = ranges.groupBy("user_id").agg(F.sum("_n").alias("n_orders")).select(F.expr("user_id ^ 0").alias("user_id"), "n_orders")
    ev = ev.join(count, "user_id", "left").withColumn("nth", F.col("event_id") % F.col("n_orders"))
    return ev.join(order, ["user_id", "nth"], "left").drop("nth", "n_orders")


def calls(t: Tables) -> DataFrame:
    """Call log: (call_id, project_id, start_time, direction, duration_s, agent, users_email, manager_name)."""
    n = _n_agents(t)
    e = F.col("event_id")
    c = _events_with_project(t).withColumn("agent_id", _agent_of(F.col("user_id"), e, n))
    a = agents(t).select(F.col("user_id").alias("agent_id"), "name", "email", "manager_name")
    c = c.join(a, "agent_id", "left")
    return c.select(
        e.alias("call_id"),
        F.col("project_id"),
        F.col("ts").alias("start_time"),
        F.when(e % 29 == 0, F.lit(None).cast("string"))
        .when(F.col("event_type").isin("purchase", "view"), F.lit("out"))
        .otherwise(F.lit("in"))
        .alias("direction"),
        F.when(F.col("event_type").isin("error", "view") & (e % 2 == 0), F.lit(None).cast("double"))
        .when(e % 5 == 0, F.floor(F.col("value") / 10).cast("double"))
        .otherwise(F.floor(F.col("value") * 12).cast("double"))
        .alias("duration_s"),
        F.when(e % 10 == 7, F.upper("name")).otherwise(F.col("name")).alias("agent"),
        F.when(e % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("email")).alias("users_email"),
        F.col("manager_name"),
    )


def _created_at(o: DataFrame) -> Column:
    d = F.datediff(F.to_date("o_orderdate"), F.lit(BASE_DAY).cast("date"))
    return add_hours(add_days(F.lit(CREATED_BASE).cast("timestamp_ntz"), d % 75), F.col("o_orderkey") % 5)


def opps_core(t: Tables, *extra: str) -> DataFrame:
    """(opp_id, account_id, project_id, created_at, mandate_signed_at) per order, with ``extra`` order columns."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", *extra)
    k = F.col("o_orderkey")
    base = o.select(
        k.alias("opp_id"), F.col("o_custkey").alias("account_id"), k.alias("project_id"), _created_at(o).alias("created_at"), *extra
    )
    K = F.col("opp_id")
    return base.withColumn(
        "mandate_signed_at",
        F.when(K % 19 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
            add_hours(add_days(F.col("created_at"), K % 30), K % 24)
        ),
    )


def opps(t: Tables) -> DataFrame:
    """CRM opportunity joined with its project bridge, one row per opportunity."""
    n = _n_agents(t)
    j = opps_core(t, "o_orderstatus", "o_orderpriority")
    K = F.col("opp_id")
    C = F.col("created_at")
    ts_null = F.lit(None).cast("timestamp_ntz")
    return j.select(
        "opp_id",
        "account_id",
        "project_id",
        "created_at",
        "mandate_signed_at",
        F.pmod(K, n).alias("owner_id"),
        F.when(K % 17 == 0, F.lit("OTHER")).otherwise(F.lit("MAIN")).alias("record_type_id"),
        _pick(STAGES, K % 8).alias("stage"),
        (F.col("o_orderstatus") == "F").alias("is_closed"),
        (K % 10 == 3).alias("visio"),
        F.when(K % 13 == 0, F.lit(None).cast("boolean")).when(K % 5 == 0, F.lit(True)).otherwise(F.lit(False)).alias("is_pro"),
        F.when(K % 7 == 0, F.lit("LEAD_OWNER_JUNIOR"))
        .when(K % 7 == 1, F.lit("LEAD_OWNER_SENIOR"))
        .otherwise(F.lit("LEAD_OWNER_MAIN"))
        .alias("lead_owner"),
        F.when(K % 10 == 0, F.lit("price")).alias("lost_reason"),
        F.when(K % 4 == 0, ts_null).when(K % 11 == 1, add_days(C, -3000)).otherwise(add_days(C, (K * 7) % 60)).alias("compromise_at"),
        F.when(K % 5 == 0, ts_null).otherwise(add_days(C, (K * 13) % 60 - 10)).alias("suspensive_at"),
        F.when(K % 3 == 0, add_days(C, K % 100)).alias("lost_at"),
        F.when(K % 6 == 0, add_days(C, K % 50 + 20)).alias("offer_edited_at"),
        F.when(K % 8 == 0, add_days(C, 100)).alias("funds_at"),
        F.col("o_orderpriority").alias("channel"),
    )


def opp_stages(t: Tables) -> DataFrame:
    """Process-stage dates per opportunity from its line items (one partial aggregation).

    Stage i is 4*i days after the order's earliest ship-day offset; some stages are
    missing and, for one opportunity in five, stage 4 falls on the day of stage 3.
    """
    from callpulse.config import STAGE_COLUMNS

    li = t.lineitem.select("l_orderkey", "l_shipdate")
    off = F.datediff(F.to_date("l_shipdate"), F.lit(BASE_DAY).cast("date")) % 30
    agg = li.groupBy("l_orderkey").agg(F.min(off).alias("b"))
    core = opps_core(t).select("opp_id", "created_at")
    j = agg.join(core, agg.l_orderkey == core.opp_id)
    K = F.col("opp_id")
    cols = []
    for i, c in enumerate(STAGE_COLUMNS):
        shift = F.col("b") + (4 * i - 5)
        if i == 4:
            shift = F.when(K % 5 == 0, shift - 4).otherwise(shift)
        cols.append(
            F.when((K * (i + 1)) % 7 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(add_days("created_at", shift)).alias(c)
        )
    return j.select("opp_id", *cols)


def reviews(t: Tables) -> DataFrame:
    """Customer reviews of three sources: (review_id, opp_id, account_id, source, rating, review_ts)."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    core = opps_core(t).select("opp_id", "account_id", "created_at")
    j = li.join(core, li.l_orderkey == core.opp_id)
    P = F.col("l_partkey")
    rt = add_hours(add_days("created_at", P % 80), F.col("l_suppkey") % 24)
    rt = F.when(P % 17 == 0, add_days(rt, -1461)).otherwise(rt)
    return j.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("review_id"),
        "opp_id",
        "account_id",
        _pick(REVIEW_SOURCES, F.col("l_linenumber") % 3).alias("source"),
        F.when(P % 23 == 0, F.lit(None).cast("double")).otherwise(_pick(RATINGS, P % 6)).alias("rating"),
        rt.alias("review_ts"),
    )


def mandate_events(t: Tables) -> DataFrame:
    """Mandate-approved events: (project_id, received_at); repeats and orphans included (one scan)."""
    m = opps_core(t).select("opp_id", "project_id", "mandate_signed_at").where(F.col("mandate_signed_at").isNotNull())
    K, P, M = F.col("opp_id"), F.col("project_id"), F.col("mandate_signed_at")

    def ev(project, received):
        return F.struct(project.alias("project_id"), received.alias("received_at"))

    events = F.array(
        ev(P, M),
        F.when(K % 9 == 0, ev(P, add_days(M, 2))),
        F.when(K % 50 == 0, ev(-1 - P, M)),
    )
    return m.select(F.explode(events).alias("e")).where(F.col("e").isNotNull()).select("e.project_id", "e.received_at")


def bank_requests(t: Tables) -> DataFrame:
    """Project to opportunity bridge: (project_id, opp_id)."""
    return opps_core(t).select("project_id", "opp_id")


def appointments(t: Tables) -> DataFrame:
    """Calendar events: (event_id, account_id, owner_id, start_at, status, type, is_deleted, subject)."""
    n = _n_agents(t)
    ev = t.events.select("event_id", "ts", "user_id", "event_type").where(F.col("event_type") == "signup")
    e = F.col("event_id")
    return ev.select(
        e.alias("event_id"),
        F.col("user_id").alias("account_id"),
        _agent_of(F.col("user_id"), e, n).alias("owner_id"),
        add_hours(F.to_date("ts").cast("timestamp_ntz"), F.hour("ts")).alias("start_at"),
        _pick(APPOINTMENT_STATUSES, e % 3).alias("status"),
        F.when(e % 4 == 0, F.lit("Meeting")).otherwise(F.lit("Call")).alias("type"),
        (e % 11 == 0).alias("is_deleted"),
        F.when(e % 5 == 1, F.lit(SCHEDULE_SUBJECTS[1])).otherwise(F.lit(SCHEDULE_SUBJECTS[0])).alias("subject"),
    )


def tasks(t: Tables) -> DataFrame:
    """CRM tasks (logged calls): (task_id, opp_id, owner_id, created_at, subject)."""
    n = _n_agents(t)
    e = F.col("event_id")
    ev = _events_with_project(t)
    return ev.select(
        e.alias("task_id"),
        F.col("project_id").alias("opp_id"),
        _agent_of(F.col("user_id"), e, n).alias("owner_id"),
        F.col("ts").alias("created_at"),
        _pick(TASK_SUBJECTS, e % 5).alias("subject"),
    )


def absences(t: Tables) -> DataFrame:
    """Agent absence days: distinct (user_id, absent_on)."""
    n = _n_agents(t)
    ev = t.events.select("event_id", "ts", "user_id")
    agent = _agent_of(F.col("user_id"), F.col("event_id"), n)
    return (
        ev.select(agent.alias("user_id"), F.to_date("ts").alias("absent_on"))
        .where(F.pmod(F.col("user_id") + F.dayofmonth("absent_on"), F.lit(7)) == 0)
        .distinct()
    )


def reassignments(t: Tables) -> DataFrame:
    """Owner reassignment count per account: (account_id, cnt)."""
    ev = t.events.select("user_id", "event_type").where(F.col("event_type") == "error")
    return ev.groupBy(F.col("user_id").alias("account_id")).agg(F.count(F.lit(1)).alias("cnt"))


def _scored_events(t: Tables, event_type: str, where: Column | None = None) -> DataFrame:
    cond = F.col("event_type") == event_type
    if where is not None:
        cond = cond & where
    e = F.col("event_id")
    ev = _events_with_project(t, cond)
    return ev.select(
        e.alias("event_id"),
        F.col("user_id").alias("account_id"),
        F.col("project_id").alias("opp_id"),
        F.to_date("ts").cast("timestamp_ntz").alias("date_pred"),
        F.col("value"),
    )


def scores(t: Tables) -> DataFrame:
    """Previously written daily scores: (account_id, opp_id, proba, url, date_pred)."""
    s = _scored_events(t, "view")
    return s.select(
        "account_id",
        "opp_id",
        (F.col("value") / 500.0).alias("proba"),
        F.concat(F.lit(URL_PREFIX), F.col("opp_id").cast("string")).alias("url"),
        "date_pred",
    )


def _alert_rows(t: Tables, parity: int) -> DataFrame:
    s = _scored_events(t, "click", F.col("event_id") % 2 == parity)
    e = F.col("event_id")
    return s.select(
        "date_pred",
        "opp_id",
        F.concat(F.lit(URL_PREFIX), F.col("opp_id").cast("string")).alias("url"),
        F.round(F.col("value") / 5.0).alias("proba"),
        _pick(TREATMENTS, e % 3).alias("treatment"),
    )


def alert_history(t: Tables) -> DataFrame:
    """Alert history table: (date_pred, opp_id, url, proba, treatment)."""
    return _alert_rows(t, 0)


def previous_alerts(t: Tables) -> DataFrame:
    """Previous day's alert list with the handling marks."""
    return _alert_rows(t, 1)


def name_texts(t: Tables) -> DataFrame:
    """Accented free text for the folding operator: (conv_id, turn, text)."""
    return t.conversations.select("conv_id", "turn", "text")
