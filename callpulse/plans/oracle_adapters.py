"""DuckDB SQL twins of ``callpulse.sources.adapters`` (the correctness oracle).

Each entry is one CTE body over the driver's pre-registered views. ``with_ctes``
prepends the CTEs a query needs, in dependency order.
"""

from __future__ import annotations

from callpulse.sources.adapters import (
    AGENT_FIRST_NAMES,
    APPOINTMENT_STATUSES,
    BASE_DAY,
    CREATED_BASE,
    RATINGS,
    REVIEW_SOURCES,
    ROLE_CODES,
    SCHEDULE_SUBJECTS,
    STAGES,
    TASK_SUBJECTS,
    URL_PREFIX,
)


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _list(values) -> str:
    return "[" + ", ".join(_lit(v) for v in values) + "]"


def _days(x: str) -> str:
    return f"to_days(CAST({x} AS INTEGER))"


def _hours(x: str) -> str:
    return f"to_hours(CAST({x} AS BIGINT))"


AGENT_OF = "(({u}) * 7 + ({e}) % 3) % (SELECT n FROM n_agents)"

# name -> (dependencies, SQL body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


_cte("n_agents", (), "SELECT count(*) AS n FROM supplier")

_cte(
    "agents",
    (),
    f"""SELECT s.s_suppkey AS user_id,
       {_list(AGENT_FIRST_NAMES)}[s.s_suppkey % 8 + 1] || ' ' || CAST(s.s_suppkey AS VARCHAR) AS name,
       'a' || CAST(s.s_suppkey AS VARCHAR) || '@x.org' AS email,
       CASE WHEN s.s_suppkey % 6 = 5 THEN NULL ELSE n.n_name END AS manager_name,
       {_list(ROLE_CODES)}[s.s_suppkey % 4 + 1] AS role_id
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
)

_cte(
    "project_bounds",
    (),
    """SELECT o_custkey, o_orderkey AS project_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS nth,
       count(*) OVER (PARTITION BY o_custkey) AS n_orders FROM orders""",
)

_cte(
    "calls",
    ("n_agents", "agents", "project_bounds"),
    f"""SELECT e.event_id AS call_id,
       pb.project_id AS project_id,
       e.ts AS start_time,
       CASE WHEN e.event_id % 29 = 0 THEN NULL
            WHEN e.event_type IN ('purchase', 'view') THEN 'out' ELSE 'in' END AS direction,
       CASE WHEN e.event_type IN ('error', 'view') AND e.event_id % 2 = 0 THEN NULL
            WHEN e.event_id % 5 = 0 THEN CAST(floor(e.value / 10) AS DOUBLE)
            ELSE CAST(floor(e.value * 12) AS DOUBLE) END AS duration_s,
       CASE WHEN e.event_id % 10 = 7 THEN upper(a.name) ELSE a.name END AS agent,
       CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE a.email END AS users_email,
       a.manager_name
FROM events e
LEFT JOIN project_bounds pb ON e.user_id = pb.o_custkey AND e.event_id % pb.n_orders = pb.nth
LEFT JOIN agents a ON a.user_id = {AGENT_OF.format(u='e.user_id', e='e.event_id')}""",
)

_cte(
    "opps_core",
    (),
    f"""SELECT opp_id, account_id, project_id, created_at,
       CASE WHEN opp_id % 19 = 0 THEN NULL
            ELSE created_at + {_days('opp_id % 30')} + {_hours('opp_id % 24')} END AS mandate_signed_at
FROM (
  SELECT o_orderkey AS opp_id, o_custkey AS account_id, o_orderkey AS project_id,
         TIMESTAMP '{CREATED_BASE}'
           + {_days(f"date_diff('day', DATE '{BASE_DAY}', CAST(o_orderdate AS DATE)) % 75")}
           + {_hours('o_orderkey % 5')} AS created_at
  FROM orders) x""",
)

_cte(
    "opps",
    ("n_agents", "opps_core"),
    f"""SELECT c.opp_id, c.account_id, c.project_id, c.created_at, c.mandate_signed_at,
       c.opp_id % (SELECT n FROM n_agents) AS owner_id,
       CASE WHEN c.opp_id % 17 = 0 THEN 'OTHER' ELSE 'MAIN' END AS record_type_id,
       {_list(STAGES)}[c.opp_id % 8 + 1] AS stage,
       o.o_orderstatus = 'F' AS is_closed,
       c.opp_id % 10 = 3 AS visio,
       CASE WHEN c.opp_id % 13 = 0 THEN NULL WHEN c.opp_id % 5 = 0 THEN TRUE ELSE FALSE END AS is_pro,
       CASE WHEN c.opp_id % 7 = 0 THEN 'LEAD_OWNER_JUNIOR' WHEN c.opp_id % 7 = 1 THEN 'LEAD_OWNER_SENIOR'
            ELSE 'LEAD_OWNER_MAIN' END AS lead_owner,
       CASE WHEN c.opp_id % 10 = 0 THEN 'price' END AS lost_reason,
       CASE WHEN c.opp_id % 4 = 0 THEN NULL
            WHEN c.opp_id % 11 = 1 THEN c.created_at + {_days('-3000')}
            ELSE c.created_at + {_days('(c.opp_id * 7) % 60')} END AS compromise_at,
       CASE WHEN c.opp_id % 5 = 0 THEN NULL
            ELSE c.created_at + {_days('(c.opp_id * 13) % 60 - 10')} END AS suspensive_at,
       CASE WHEN c.opp_id % 3 = 0 THEN c.created_at + {_days('c.opp_id % 100')} END AS lost_at,
       CASE WHEN c.opp_id % 6 = 0 THEN c.created_at + {_days('c.opp_id % 50 + 20')} END AS offer_edited_at,
       CASE WHEN c.opp_id % 8 = 0 THEN c.created_at + {_days('100')} END AS funds_at,
       o.o_orderpriority AS channel
FROM opps_core c JOIN orders o ON o.o_orderkey = c.opp_id""",
)


def _stage_sql() -> str:
    from callpulse.config import STAGE_COLUMNS

    cols = []
    for i, name in enumerate(STAGE_COLUMNS):
        shift = f"a.b + {4 * i - 5}"
        if i == 4:
            shift = f"CASE WHEN c.opp_id % 5 = 0 THEN {shift} - 4 ELSE {shift} END"
        cols.append(f"CASE WHEN (c.opp_id * {i + 1}) % 7 = 0 THEN NULL ELSE c.created_at + {_days(shift)} END AS {name}")
    sel = ",\n       ".join(cols)
    return f"""SELECT c.opp_id,
       {sel}
FROM (SELECT l_orderkey, min(date_diff('day', DATE '{BASE_DAY}', CAST(l_shipdate AS DATE)) % 30) AS b
      FROM lineitem GROUP BY l_orderkey) a
JOIN opps_core c ON a.l_orderkey = c.opp_id"""


_cte("opp_stages", ("opps_core",), _stage_sql())

_cte(
    "reviews",
    ("opps_core",),
    f"""SELECT l.l_orderkey * 8 + l.l_linenumber AS review_id, c.opp_id, c.account_id,
       {_list(REVIEW_SOURCES)}[l.l_linenumber % 3 + 1] AS source,
       CASE WHEN l.l_partkey % 23 = 0 THEN NULL
            ELSE CAST({_list(RATINGS)}[l.l_partkey % 6 + 1] AS DOUBLE) END AS rating,
       CASE WHEN l.l_partkey % 17 = 0
            THEN c.created_at + {_days('l.l_partkey % 80')} + {_hours('l.l_suppkey % 24')} + {_days('-1461')}
            ELSE c.created_at + {_days('l.l_partkey % 80')} + {_hours('l.l_suppkey % 24')} END AS review_ts
FROM lineitem l JOIN opps_core c ON l.l_orderkey = c.opp_id""",
)

_cte(
    "mandate_events",
    ("opps_core",),
    f"""SELECT project_id, mandate_signed_at AS received_at FROM opps_core WHERE mandate_signed_at IS NOT NULL
UNION ALL
SELECT project_id, mandate_signed_at + {_days('2')} FROM opps_core WHERE mandate_signed_at IS NOT NULL AND opp_id % 9 = 0
UNION ALL
SELECT -1 - project_id, mandate_signed_at FROM opps_core WHERE mandate_signed_at IS NOT NULL AND opp_id % 50 = 0""",
)

_cte("bank_requests", ("opps_core",), "SELECT project_id, opp_id FROM opps_core")

_cte(
    "appointments",
    ("n_agents",),
    f"""SELECT event_id, user_id AS account_id,
       {AGENT_OF.format(u='user_id', e='event_id')} AS owner_id,
       date_trunc('hour', ts) AS start_at,
       {_list(APPOINTMENT_STATUSES)}[event_id % 3 + 1] AS status,
       CASE WHEN event_id % 4 = 0 THEN 'Meeting' ELSE 'Call' END AS type,
       event_id % 11 = 0 AS is_deleted,
       CASE WHEN event_id % 5 = 1 THEN {_lit(SCHEDULE_SUBJECTS[1])} ELSE {_lit(SCHEDULE_SUBJECTS[0])} END AS subject
FROM events WHERE event_type = 'signup'""",
)

_cte(
    "tasks",
    ("n_agents", "project_bounds"),
    f"""SELECT e.event_id AS task_id,
       pb.project_id AS opp_id,
       {AGENT_OF.format(u='e.user_id', e='e.event_id')} AS owner_id,
       e.ts AS created_at,
       {_list(TASK_SUBJECTS)}[e.event_id % 5 + 1] AS subject
FROM events e LEFT JOIN project_bounds pb ON e.user_id = pb.o_custkey AND e.event_id % pb.n_orders = pb.nth""",
)

_cte(
    "absences",
    ("n_agents",),
    f"""SELECT DISTINCT user_id, absent_on FROM (
  SELECT {AGENT_OF.format(u='user_id', e='event_id')} AS user_id, CAST(ts AS DATE) AS absent_on FROM events) x
WHERE (user_id + dayofmonth(absent_on)) % 7 = 0""",
)

_cte(
    "reassignments",
    (),
    "SELECT user_id AS account_id, count(*) AS cnt FROM events WHERE event_type = 'error' GROUP BY user_id",
)

_SCORED = """SELECT e.event_id, e.user_id AS account_id,
       pb.project_id AS opp_id,
       CAST(CAST(e.ts AS DATE) AS TIMESTAMP) AS date_pred, e.value
FROM events e LEFT JOIN project_bounds pb ON e.user_id = pb.o_custkey AND e.event_id % pb.n_orders = pb.nth
WHERE e.event_type = '{etype}'{extra}"""

_cte(
    "scores",
    ("project_bounds",),
    f"""SELECT account_id, opp_id, value / 500.0 AS proba,
       {_lit(URL_PREFIX)} || CAST(opp_id AS VARCHAR) AS url, date_pred
FROM ({_SCORED.format(etype='view', extra='')}) s""",
)


def _alerts_sql(parity: int) -> str:
    inner = _SCORED.format(etype="click", extra=f" AND e.event_id % 2 = {parity}")
    return f"""SELECT date_pred, opp_id, {_lit(URL_PREFIX)} || CAST(opp_id AS VARCHAR) AS url,
       CAST(round(value / 5.0) AS DOUBLE) AS proba,
       ['', NULL, 'done'][event_id % 3 + 1] AS treatment
FROM ({inner}) s"""


_cte("alert_history", ("project_bounds",), _alerts_sql(0))
_cte("previous_alerts", ("project_bounds",), _alerts_sql(1))


def _resolve(names, out: list[str]) -> None:
    for n in names:
        if n in out:
            continue
        deps, _ = CTES[n]
        _resolve(deps, out)
        if n not in out:
            out.append(n)


def with_ctes(needs: list[str] | tuple[str, ...], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` the adapter CTEs in ``needs`` (plus dependencies) and ``extra`` (name, sql), then ``body``."""
    order: list[str] = []
    _resolve(needs, order)
    parts = [f"{n} AS (\n{CTES[n][1]}\n)" for n in order]
    for name, sql in extra or []:
        parts.append(f"{name} AS (\n{sql}\n)")
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
