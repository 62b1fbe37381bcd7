"""DuckDB oracle SQL per registered query.

Written directly from the feature definitions (per-KEY filtered counts,
row_number keep-first, per-call lag for gaps, repeated rows for weighted
medians), not from the Spark plan, so that it cross-checks the plan.
"""

from __future__ import annotations

import re

from callpulse.config import CRM_DATE_COLUMNS, MEDIAN_FILL_COLUMNS, MODEL_FEATURES, STAGE_COLUMNS, Config
from callpulse.plans import oracle_adapters as OA
from callpulse.plans.oracle_adapters import _cte, _lit, with_ctes

CFG = Config()
K = "account_id, opp_id, ref_date"


def fd(a: str, b: str) -> str:
    """Floored whole days from b to a."""
    return f"CAST(floor(date_diff('microsecond', {b}, {a}) / 86400000000.0) AS BIGINT)"


def rd(x: str) -> str:
    """Round to the nearest day, ties to even."""
    return f"CAST(DATE '1970-01-01' + CAST(round_even(epoch_us({x}) / 86400000000.0, 0) AS INTEGER) AS TIMESTAMP)"


def days(x) -> str:
    return f"to_days(CAST({x} AS INTEGER))"


def inlist(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


def fold(x: str) -> str:
    return f"regexp_replace(lower(strip_accents({x})), '[^\\x00-\\x7F]', '', 'g')"


EXPERTS = inlist(CFG.expert_roles)
KEPT_MGR = f"NOT coalesce(manager_name IN {inlist(CFG.excluded_managers)}, false)"

# ---------------------------------------------------------------- warehouse
_cte(
    "calls_opp",
    ("calls", "opps"),
    """SELECT c.*, o.opp_id, o.account_id, o.record_type_id
FROM calls c JOIN opps o ON c.project_id = o.project_id""",
)

_cte(
    "missed_status",
    ("calls_opp",),
    f"""SELECT account_id, opp_id, CAST(start_time AS DATE) AS call_day,
       CASE WHEN count(*) FILTER (WHERE duration_s < {CFG.callback_below_s}) = 0 THEN 'no_callback'
            ELSE 'same_day_callback' END AS missed_status
FROM calls_opp
GROUP BY account_id, opp_id, CAST(start_time AS DATE)
HAVING bool_or(coalesce(direction = 'in' AND (duration_s < {CFG.missed_below_s} OR duration_s IS NULL), false))""",
)

_SLOT_WHERE = f"""a.is_deleted = false AND lower(a.status) LIKE {_lit(CFG.schedule_status_like)}
  AND a.type = {_lit(CFG.schedule_type)} AND a.subject LIKE {_lit(CFG.schedule_subject_like)}"""

_cte(
    "slots_agent",
    ("appointments", "agents"),
    f"""SELECT a.account_id, a.owner_id, u.name AS expert_name, CAST(a.start_at AS DATE) AS slot_day,
       min(a.start_at) AS slot_at
FROM appointments a LEFT JOIN agents u ON a.owner_id = u.user_id
WHERE {_SLOT_WHERE}
GROUP BY a.account_id, a.owner_id, u.name, CAST(a.start_at AS DATE)""",
)

_cte(
    "slots_account",
    ("appointments", "agents"),
    f"""SELECT a.account_id, CAST(a.start_at AS DATE) AS slot_day, min(a.start_at) AS slot_at
FROM appointments a LEFT JOIN agents u ON a.owner_id = u.user_id
WHERE {_SLOT_WHERE} AND u.role_id IN {EXPERTS}
GROUP BY a.account_id, CAST(a.start_at AS DATE)""",
)

_TASK_WHERE = f"""lower(t.subject) LIKE '%inbound%' OR lower(t.subject) LIKE '%outbound%'
  OR (lower(t.subject) LIKE '%appel%' AND lower(t.subject) LIKE '%démarr%')
  OR lower(t.subject) LIKE '%missed%' AND u.role_id IN {EXPERTS}"""

_cte(
    "realised_agent",
    ("tasks", "opps", "agents"),
    f"""SELECT o.account_id, CAST(t.created_at AS DATE) AS call_day, u.name AS expert_name,
       min(t.created_at) AS first_call_at
FROM tasks t LEFT JOIN opps o ON t.opp_id = o.opp_id LEFT JOIN agents u ON t.owner_id = u.user_id
WHERE {_TASK_WHERE}
GROUP BY o.account_id, CAST(t.created_at AS DATE), u.name""",
)

_cte(
    "realised_account",
    ("tasks", "opps", "agents"),
    f"""SELECT o.account_id, CAST(t.created_at AS DATE) AS call_day, min(t.created_at) AS first_call_at
FROM tasks t LEFT JOIN opps o ON t.opp_id = o.opp_id LEFT JOIN agents u ON t.owner_id = u.user_id
WHERE {_TASK_WHERE}
GROUP BY o.account_id, CAST(t.created_at AS DATE)""",
)


def _punct_sql(slots: str, realised: str, group: str) -> str:
    m = "date_sub('minute', s.slot_at, r.first_call_at)"
    return f"""SELECT s.{group},
       count(*) FILTER (WHERE r.first_call_at IS NULL) AS no_show,
       count(*) FILTER (WHERE {m} < 1) AS on_time,
       count(*) FILTER (WHERE {m} < 5) AS late_lt5,
       count(*) FILTER (WHERE {m} < 15) AS late_lt15,
       count(*) FILTER (WHERE {m} >= 15) AS late_ge_15
FROM {slots} s LEFT JOIN {realised} r ON s.account_id = r.account_id AND s.slot_day = r.call_day
GROUP BY s.{group}"""


_cte("punct_agent", ("slots_agent", "realised_agent"), _punct_sql("slots_agent", "realised_agent", "expert_name"))
_cte("punct_account", ("slots_account", "realised_account"), _punct_sql("slots_account", "realised_account", "account_id"))

PUNCT = "no_show, on_time, late_lt5, late_lt15, late_ge_15"


def _call_base_sql(by: str) -> str:
    join = "p.expert_name = u.name" if by == "agent" else "p.account_id = c.account_id"
    src = "punct_agent" if by == "agent" else "punct_account"
    return f"""SELECT c.call_id, c.opp_id, c.account_id, c.direction, c.start_time, c.duration_s, c.agent,
       u.name AS expert_name, c.manager_name, u.role_id, ms.missed_status,
       p.no_show, p.on_time, p.late_lt5, p.late_lt15, p.late_ge_15,
       CASE WHEN ab.user_id IS NOT NULL THEN 'absent' ELSE 'work' END AS absence_flag
FROM calls_opp c
LEFT JOIN agents u ON u.email = c.users_email
LEFT JOIN missed_status ms ON ms.account_id = c.account_id AND ms.opp_id = c.opp_id
     AND ms.call_day = CAST(c.start_time AS DATE)
LEFT JOIN {src} p ON {join}
LEFT JOIN absences ab ON ab.user_id = u.user_id AND ab.absent_on = CAST(c.start_time AS DATE)
WHERE c.opp_id IS NOT NULL AND c.account_id IS NOT NULL AND c.record_type_id = {_lit(CFG.main_record_type)}"""


_cte("call_base_agent", ("calls_opp", "agents", "missed_status", "punct_agent", "absences"), _call_base_sql("agent"))
_cte("call_base_account", ("calls_opp", "agents", "missed_status", "punct_account", "absences"), _call_base_sql("account"))

OPP_COLS = (
    "opp_id, account_id, created_at, mandate_signed_at, stage, channel, owner_name, record_type_id, compromise_at, "
    "suspensive_at, lost_at, offer_edited_at, funds_at, " + ", ".join(STAGE_COLUMNS)
)

_cte(
    "opps_train",
    ("opps", "opp_stages", "agents"),
    f"""SELECT o.opp_id, o.account_id, o.created_at, o.mandate_signed_at, o.stage, o.channel, u.name AS owner_name,
       o.record_type_id,
       CASE WHEN CAST(o.compromise_at AS DATE) > DATE '{CFG.as_of}'
              OR o.compromise_at < TIMESTAMP '{CFG.compromise_min_date} 00:00:00' THEN NULL
            ELSE o.compromise_at END AS compromise_at,
       o.suspensive_at, o.lost_at, o.offer_edited_at, o.funds_at,
       {", ".join("s." + c for c in STAGE_COLUMNS)}
FROM opps o LEFT JOIN opp_stages s ON o.opp_id = s.opp_id LEFT JOIN agents u ON o.owner_id = u.user_id
WHERE o.mandate_signed_at IS NOT NULL AND o.record_type_id = {_lit(CFG.main_record_type)}""",
)

_cte(
    "opps_open",
    ("opps_train", "opps", "reassignments"),
    f"""SELECT {", ".join("t." + c.strip() for c in OPP_COLS.split(","))}, o.lost_reason, r.cnt AS n_reassignments
FROM opps_train t JOIN opps o ON t.opp_id = o.opp_id LEFT JOIN reassignments r ON r.account_id = t.account_id
WHERE o.is_closed = false AND o.stage NOT IN {inlist(CFG.closed_stages)}
  AND t.owner_name NOT IN {inlist(CFG.excluded_owner_names)} AND o.visio = false""",
)

_cte(
    "mandates_train",
    ("mandate_events", "bank_requests"),
    "SELECT m.received_at, b.opp_id FROM mandate_events m LEFT JOIN bank_requests b ON m.project_id = b.project_id",
)

_cte(
    "mandates_open",
    ("opps",),
    f"""SELECT opp_id, account_id, mandate_signed_at AS mandate_at FROM opps
WHERE mandate_signed_at IS NOT NULL AND funds_at IS NULL AND is_closed = false
  AND stage NOT IN {inlist(CFG.closed_stages)} AND lead_owner = {_lit(CFG.scoring_lead_owner)}""",
)

# ---------------------------------------------------------------- labels
LABEL_COLS = "opp_id, account_id, ref_date, rating, mandate_date, mandate_delta_days"

_cte(
    "labels_train",
    ("mandates_train", "reviews"),
    f"""SELECT {LABEL_COLS} FROM (
  SELECT j.*, row_number() OVER (PARTITION BY opp_id
           ORDER BY mandate_delta_days DESC, source, review_id, review_ts, rating NULLS FIRST, mandate_date) AS rn
  FROM (
    SELECT r.opp_id, r.account_id, r.rating, r.source, r.review_id, r.review_ts, r.ref_date, m.mandate_date,
           {fd('m.mandate_date', 'r.ref_date')} AS mandate_delta_days
    FROM (SELECT opp_id, account_id, CAST(rating AS DOUBLE) AS rating, source, review_id, review_ts,
                 {rd('review_ts')} AS ref_date
          FROM reviews WHERE review_ts > TIMESTAMP '{CFG.review_min_date} 00:00:00') r
    JOIN (SELECT opp_id, {rd('received_at')} AS mandate_date
          FROM (SELECT DISTINCT opp_id, received_at FROM mandates_train) d) m ON r.opp_id = m.opp_id
  ) j WHERE mandate_delta_days < 0
) k WHERE rn = 1""",
)

_cte(
    "labels_shifted",
    ("labels_train",),
    f"""SELECT opp_id, account_id, ref_date - {days('s.shift')} AS ref_date, rating, mandate_date, mandate_delta_days
FROM labels_train, (VALUES {", ".join(f"({x})" for x in (0, *CFG.shift_days))}) s(shift)""",
)

_cte(
    "labels_score",
    ("mandates_open",),
    f"""SELECT opp_id, account_id, ref_date, CAST(NULL AS DOUBLE) AS rating, mandate_date, mandate_delta_days FROM (
  SELECT x.*, row_number() OVER (PARTITION BY opp_id ORDER BY mandate_delta_days DESC, account_id, mandate_date) AS rn
  FROM (
    SELECT opp_id, account_id, mandate_date, TIMESTAMP '{CFG.as_of} 00:00:00' AS ref_date,
           {fd('mandate_date', "TIMESTAMP '" + str(CFG.as_of) + " 00:00:00'")} AS mandate_delta_days
    FROM (SELECT opp_id, account_id, {rd('mandate_at')} AS mandate_date FROM mandates_open) m
    WHERE opp_id IS NOT NULL AND account_id IS NOT NULL AND mandate_date IS NOT NULL
  ) x WHERE mandate_delta_days < 0
) k WHERE rn = 1""",
)

# ---------------------------------------------------------------- call window and features
_cte(
    "first_expert",
    ("call_base_agent",),
    f"""SELECT agent, min(start_time) AS first_expert_call FROM call_base_agent
WHERE role_id IN {EXPERTS} AND agent IS NOT NULL GROUP BY agent""",
)

_cte(
    "cw",
    ("call_base_agent", "first_expert", "labels_shifted"),
    f"""SELECT c.account_id, c.opp_id, l.ref_date, l.opp_id AS label_opp_id, l.rating, l.mandate_date,
       l.mandate_delta_days, c.call_id, c.start_time, c.direction,
       CASE WHEN c.duration_s > {CFG.duration_cap_s} THEN {CFG.duration_cap_s} ELSE c.duration_s END AS duration_s,
       c.agent, {fold('c.agent')} AS agent_norm, c.expert_name, c.manager_name, c.role_id,
       CASE WHEN c.role_id IN {EXPERTS} THEN 'expert' WHEN c.role_id = {_lit(CFG.bizdev_role)} THEN 'bizdev'
            ELSE 'other' END AS role,
       c.missed_status, c.{PUNCT.replace(', ', ', c.')}, c.absence_flag, f.first_expert_call
FROM call_base_agent c
LEFT JOIN first_expert f ON f.agent = c.agent
JOIN labels_shifted l ON c.account_id = l.account_id AND c.start_time < l.ref_date
     AND c.start_time > l.ref_date - {days(CFG.window_days)}""",
)


def _cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def _pct(a: str, b: str) -> str:
    return f"coalesce(100.0::DOUBLE * {a} / nullif({b}, 0), 0.0)"


_cats = {
    "expert": f"role_id IN {EXPERTS}",
    "bizdev": f"role_id = {_lit(CFG.bizdev_role)}",
    "customer_care": f"role_id = {_lit(CFG.bizdev_role)} AND manager_name = {_lit(CFG.customer_care_manager)}",
}
_cat_aggs = ",\n       ".join(
    f"{_cnt(c + ' AND start_time IS NOT NULL')} AS n_calls_{n}, {_cnt(c + " AND direction = 'in'")} AS in_{n}, "
    f"{_cnt(c + " AND direction = 'out'")} AS out_{n}"
    for n, c in _cats.items()
)

_cte(
    "kf",
    ("cw",),
    f"""SELECT {K},
       count(*) AS n_rows, count(start_time) AS n_calls_global,
       {_cnt("direction = 'in'")} AS in_global, {_cnt("direction = 'out'")} AS out_global,
       {_cat_aggs},
       {_cnt(f"duration_s > {CFG.real_call_s} AND {KEPT_MGR}")} AS n_real_kept,
       min(start_time) FILTER (WHERE duration_s > {CFG.real_call_s}) AS first_call,
       max(start_time) FILTER (WHERE duration_s > {CFG.real_call_s}) AS last_call,
       sum(duration_s) AS sum_dur, count(duration_s) AS n_dur,
       sum(duration_s) FILTER (WHERE direction = 'in') AS sum_dur_in,
       {_cnt(f"direction = 'in' AND duration_s IS NULL AND role_id IN {EXPERTS}")} AS unanswered_in,
       {_cnt("direction = 'out' AND duration_s IS NULL")} AS unanswered_out,
       {_cnt(f"duration_s > {CFG.long_call_s}")} AS n_gt_600,
       {_cnt(f"duration_s >= {CFG.medium_call_s}")} AS n_ge_180,
       {_cnt(f"duration_s >= {CFG.voicemail_min_s} AND duration_s < {CFG.voicemail_max_s} AND direction = 'out'")} AS n_voicemail,
       count(missed_status) AS n_missed_rows,
       {_cnt("missed_status = 'no_callback'")} AS n_no_callback,
       max(start_time) AS max_start, max(mandate_date) AS max_mandate
FROM cw GROUP BY {K}""",
)


def _last_nonnull(col: str, name: str) -> str:
    return f"""SELECT {K}, {col} AS {name} FROM (
  SELECT {K}, {col}, row_number() OVER (PARTITION BY {K} ORDER BY start_time DESC, call_id DESC) AS rn
  FROM cw WHERE {col.split(',')[0]} IS NOT NULL) x WHERE rn = 1"""


_cte("k_last_dir", ("cw",), _last_nonnull("direction", "last_dir"))
_cte("k_last_abs", ("cw",), _last_nonnull("absence_flag", "last_abs"))
_cte(
    "k_last_pun",
    ("cw",),
    f"""SELECT {K}, {PUNCT} FROM (
  SELECT {K}, {PUNCT}, row_number() OVER (PARTITION BY {K} ORDER BY start_time DESC, call_id DESC) AS rn
  FROM cw WHERE no_show IS NOT NULL) x WHERE rn = 1""",
)

_cte(
    "k_days",
    ("cw",),
    f"""SELECT {K},
       count(*) FILTER (WHERE n > 1) AS mc_global, count(*) FILTER (WHERE n7 > 1) AS mc_7,
       count(*) FILTER (WHERE n14 > 1) AS mc_14
FROM (SELECT {K}, CAST(start_time AS DATE) AS d,
             {_cnt(f"duration_s > {CFG.real_call_s}")} AS n,
             {_cnt(f"duration_s > {CFG.real_call_s} AND start_time > ref_date - {days(CFG.recent_windows[0])}")} AS n7,
             {_cnt(f"duration_s > {CFG.real_call_s} AND start_time > ref_date - {days(CFG.recent_windows[1])}")} AS n14
      FROM cw GROUP BY {K}, CAST(start_time AS DATE)) x
GROUP BY {K}""",
)

_cte(
    "k_gaps",
    ("cw",),
    f"""SELECT {K}, count(*) FILTER (WHERE {fd('start_time', 'prev')} > {CFG.gap_days}) AS gaps FROM (
  SELECT {K}, start_time,
         lag(start_time) OVER (PARTITION BY {K} ORDER BY start_time, call_id) AS prev
  FROM cw WHERE duration_s > {CFG.real_call_s} AND direction = 'out') x
GROUP BY {K}""",
)

_cte(
    "k_exp",
    ("cw",),
    f"""SELECT {K}, median(CAST(CASE WHEN e < 0 THEN 0 ELSE e END AS DOUBLE)) AS agent_experience_days FROM (
  SELECT {K}, agent, {fd('min(start_time)', 'min(first_expert_call)')} AS e
  FROM cw WHERE agent IS NOT NULL GROUP BY {K}, agent) x
GROUP BY {K}""",
)

_cte(
    "k_agents",
    ("cw",),
    f"""SELECT {K}, count(*) FILTER (WHERE n > 2) AS n_experts_raw, count(*) FILTER (WHERE n > 0) AS n_inter_raw FROM (
  SELECT {K}, agent_norm, {_cnt(f"duration_s > {CFG.real_call_s} AND {KEPT_MGR}")} AS n
  FROM cw WHERE agent_norm IS NOT NULL GROUP BY {K}, agent_norm) x
GROUP BY {K}""",
)

_cte(
    "k_pivot",
    ("cw",),
    """SELECT account_id, opp_id,
       nullif(count(*) FILTER (WHERE missed_status = 'no_callback'), 0) AS no_callback_count,
       nullif(count(*) FILTER (WHERE missed_status = 'same_day_callback'), 0) AS same_day_callback_count
FROM cw GROUP BY account_id, opp_id""",
)

_cat_cols = ",\n       ".join(
    f"f.n_calls_{n}, f.in_{n}, f.out_{n}, {_pct(f'f.in_{n}', f'f.in_{n} + f.out_{n}')} AS pct_in_{n}, "
    f"{_pct(f'f.out_{n}', f'f.in_{n} + f.out_{n}')} AS pct_out_{n}"
    for n in _cats
)
_AVG = "(f.sum_dur / nullif(f.n_dur, 0))"
_DIN = "(CASE WHEN f.in_global > 0 THEN coalesce(f.sum_dur_in, 0.0) END)"

_cte(
    "cf_raw",
    ("kf", "k_last_dir", "k_last_abs", "k_last_pun", "k_days", "k_gaps", "k_exp", "k_agents", "k_pivot"),
    f"""SELECT f.account_id, f.opp_id, f.ref_date, f.n_rows, f.n_calls_global, f.in_global, f.out_global,
       {_pct('f.in_global', 'f.in_global + f.out_global')} AS pct_in_global,
       {_pct('f.out_global', 'f.in_global + f.out_global')} AS pct_out_global,
       {_cat_cols},
       f.first_call, f.last_call,
       {fd('f.last_call', 'f.first_call')} / nullif(f.n_calls_global, 0) AS mean_wait_days,
       coalesce({_AVG}, 0.0) AS avg_duration, {_AVG} AS avg_duration_alt,
       f.unanswered_in, f.unanswered_out,
       coalesce(f.unanswered_in / nullif(f.in_global, 0), 0.0) AS pct_missed_in,
       coalesce(f.unanswered_out / nullif(f.out_global, 0), 0.0) AS pct_missed_out,
       {_DIN} AS duration_in, coalesce(f.sum_dur, 0.0) AS total_duration,
       {_DIN} / nullif(coalesce(f.sum_dur, 0.0), 0) AS in_time_share,
       nullif(f.n_gt_600, 0) AS n_calls_gt_600, nullif(f.n_ge_180, 0) AS n_calls_ge_180,
       nullif(f.n_voicemail, 0) AS n_voicemails,
       f.n_missed_rows, nullif(f.n_no_callback, 0) AS n_no_callback_rows,
       f.n_missed_rows / nullif(f.n_calls_global, 0) AS missed_ratio,
       nullif(f.n_no_callback, 0) / nullif(f.n_calls_global, 0) AS no_callback_ratio,
       CASE WHEN d.last_dir = 'in' THEN 0 ELSE 1 END AS last_call_out,
       CASE WHEN a.last_abs = 'absent' THEN 1 ELSE 0 END AS agent_absent,
       p.no_show, p.on_time, p.late_lt5, p.late_lt15, p.late_ge_15,
       f.max_start, f.max_mandate,
       f.n_calls_global * coalesce({_AVG}, 0.0) AS total_time,
       {fd('f.ref_date', 'f.last_call')} AS days_since_last,
       {fd('f.ref_date', 'f.first_call')} AS days_since_first,
       CAST(pv.no_callback_count AS DOUBLE) AS no_callback_count,
       CAST(pv.same_day_callback_count AS DOUBLE) AS same_day_callback_count,
       coalesce(CAST(pv.no_callback_count + pv.same_day_callback_count AS DOUBLE), 0.0) AS total_missed,
       CASE WHEN dy.mc_global > 0 THEN dy.mc_global END AS multi_call_days_global,
       CASE WHEN dy.mc_global > 0 THEN dy.mc_7 END AS multi_call_days_7d,
       CASE WHEN dy.mc_global > 0 THEN dy.mc_14 END AS multi_call_days_14d,
       nullif(g.gaps, 0) AS n_gaps_14d,
       e.agent_experience_days,
       coalesce(ag.n_experts_raw, 0) AS n_experts,
       CASE WHEN f.n_real_kept > 0 THEN coalesce(ag.n_inter_raw, 0) END AS n_interlocutors
FROM kf f
JOIN k_exp e USING ({K})
LEFT JOIN k_last_dir d USING ({K})
LEFT JOIN k_last_abs a USING ({K})
LEFT JOIN k_last_pun p USING ({K})
LEFT JOIN k_days dy USING ({K})
LEFT JOIN k_gaps g USING ({K})
LEFT JOIN k_agents ag USING ({K})
LEFT JOIN k_pivot pv USING (account_id, opp_id)""",
)

# weighted medians: each KEY repeated n_rows times
_cte(
    "cf_med",
    ("cf_raw",),
    "SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in MEDIAN_FILL_COLUMNS)
    + " FROM (SELECT r.* FROM cf_raw r, range(r.n_rows) t(i)) x",
)

_NON_NUM = {"account_id", "opp_id", "ref_date", "first_call", "last_call", "max_start", "max_mandate"}


def _call_feature_columns() -> list[str]:
    from callpulse.operators.assemble import CALL_FEATURE_COLUMNS

    return list(CALL_FEATURE_COLUMNS)


def _filled_select() -> str:
    out = []
    for c in _call_feature_columns():
        if c in MEDIAN_FILL_COLUMNS:
            out.append(f"coalesce(CAST(r.{c} AS DOUBLE), m.{c}) AS {c}")
        elif c in _NON_NUM:
            out.append(f"r.{c}")
        else:
            out.append(f"CAST(r.{c} AS DOUBLE) AS {c}")
    return ",\n       ".join(out)


_REQUIRED = ["first_call", "last_call", "max_mandate", "no_show", "on_time", "late_lt5", "late_lt15", "late_ge_15", *MEDIAN_FILL_COLUMNS]

_cte(
    "call_features",
    ("cf_raw", "cf_med"),
    f"""SELECT * FROM (SELECT {_filled_select()}
FROM cf_raw r, cf_med m) x
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _REQUIRED)}""",
)

# ---------------------------------------------------------------- CRM
_mask = ",\n       ".join(f"CASE WHEN {c} > ref_date THEN NULL ELSE {c} END AS {c}" for c in CRM_DATE_COLUMNS)
_other = [c for c in OPP_COLS.replace(" ", "").split(",") if c not in CRM_DATE_COLUMNS]

_cte(
    "crm_m",
    ("opps_train", "labels_shifted"),
    f"""SELECT * FROM (
  SELECT {", ".join("o." + c for c in _other if c not in ("opp_id", "account_id"))}, o.opp_id, o.account_id,
         l.ref_date, l.rating, l.mandate_date, l.mandate_delta_days, o.funds_at AS funds_raw,
         {", ".join("o." + c for c in CRM_DATE_COLUMNS)}
  FROM opps_train o JOIN labels_shifted l ON o.opp_id = l.opp_id AND o.account_id = l.account_id) j""",
)

_cte(
    "crm_1",
    ("crm_m",),
    f"""SELECT * REPLACE ({_mask}) FROM crm_m""",
)

_cte(
    "crm_3",
    ("crm_1",),
    """SELECT * REPLACE (CASE WHEN suspensive_at < created_at THEN NULL ELSE suspensive_at END AS suspensive_at)
FROM crm_1 WHERE ref_date > created_at""",
)
_cte(
    "crm_4",
    ("crm_3",),
    "SELECT * REPLACE (CASE WHEN lost_at < compromise_at THEN NULL ELSE compromise_at END AS compromise_at) FROM crm_3",
)
_cte(
    "crm_5",
    ("crm_4",),
    """SELECT * REPLACE (CASE WHEN suspensive_at < compromise_at AND sent_at < compromise_at THEN NULL
                          ELSE compromise_at END AS compromise_at) FROM crm_4""",
)
_cte(
    "crm_6",
    ("crm_5",),
    f"""SELECT * REPLACE (CASE WHEN {fd('suspensive_at', 'compromise_at')} > {CFG.suspensive_max_days} THEN NULL
                          ELSE suspensive_at END AS suspensive_at) FROM crm_5""",
)
_cte(
    "crm_7",
    ("crm_6",),
    f"""SELECT * REPLACE (CASE WHEN suspensive_at IS NULL AND compromise_at IS NOT NULL
                               THEN compromise_at + {days(CFG.suspensive_fill_days)} ELSE suspensive_at END AS suspensive_at)
FROM crm_6""",
)
_cte(
    "crm_8",
    ("crm_7",),
    f"""SELECT * REPLACE (CASE WHEN compromise_at IS NULL AND suspensive_at IS NOT NULL
                               THEN suspensive_at - {days(CFG.suspensive_fill_days)} ELSE compromise_at END AS compromise_at)
FROM crm_7""",
)
_lost_early = " OR ".join(f"coalesce({fd('lost_at', s)} < {CFG.lost_before_stage_days}, false)" for s in STAGE_COLUMNS)
_cte(
    "crm_clean",
    ("crm_8",),
    f"SELECT * REPLACE (CASE WHEN {_lost_early} THEN NULL ELSE lost_at END AS lost_at) FROM crm_8",
)

_last = f"greatest({', '.join(STAGE_COLUMNS)})"
_name = "''"
for _c in STAGE_COLUMNS:
    _name = f"CASE WHEN {_last} = {_c} THEN '{_c}' ELSE {_name} END"

_cte(
    "crm_features",
    ("crm_clean",),
    f"""SELECT *,
       {fd('ref_date', 'last_stage_at')} AS days_last_stage_to_ref
FROM (SELECT *,
       {fd('assembly_at', 'r1_at')} AS days_r1_to_assembly,
       {fd('sent_at', 'assembly_at')} AS days_assembly_to_sent,
       {_last} AS last_stage_at,
       {_name} AS last_stage,
       {fd('ref_date', 'suspensive_at')} AS days_suspensive_to_ref,
       {fd('sent_at', 'created_at')} AS days_created_to_sent,
       {fd('mandate_date', 'created_at')} AS days_created_to_mandate,
       {fd('ref_date', 'mandate_date')} AS days_mandate_to_ref,
       {fd('ref_date', 'sent_at')} AS days_sent_to_ref
      FROM crm_clean) x""",
)

CRM_FEATURES = (
    "days_r1_to_assembly, days_assembly_to_sent, last_stage, days_last_stage_to_ref, days_suspensive_to_ref, "
    "days_created_to_sent, days_created_to_mandate, days_mandate_to_ref, days_sent_to_ref"
)

_cte(
    "matrix",
    ("call_features", "crm_features"),
    f"""SELECT c.*, r.rating, r.mandate_delta_days, {", ".join("r." + x.strip() for x in CRM_FEATURES.split(","))}
FROM call_features c LEFT JOIN crm_features r
  ON c.account_id = r.account_id AND c.opp_id = r.opp_id AND c.ref_date = r.ref_date""",
)

_cte(
    "label_good",
    ("matrix",),
    f"""SELECT *, coalesce(rating > {CFG.good_rating_above}, false) AS is_good FROM matrix
WHERE rating IS NULL OR rating NOT IN {inlist(CFG.ambiguous_ratings)}""",
)

_cte(
    "train_rows",
    ("label_good",),
    f"""SELECT {K}, {", ".join(MODEL_FEATURES)}, is_good FROM label_good
WHERE account_id IS NOT NULL AND opp_id IS NOT NULL AND {" AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES)}""",
)

SCORE_IMPUTED = [f for f in MODEL_FEATURES if f != "mandate_delta_days"]

_cte(
    "dedup_matrix",
    ("matrix",),
    f"""SELECT account_id, opp_id, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_FEATURES)} FROM (
  SELECT *, row_number() OVER (PARTITION BY account_id, opp_id ORDER BY ref_date DESC) AS rn FROM matrix) x
WHERE rn = 1""",
)

_trace = " || ".join(f"CASE WHEN d.{c} IS NULL THEN ' / {c}' ELSE '' END" for c in SCORE_IMPUTED)

_cte(
    "impute_trace",
    ("dedup_matrix",),
    f"""SELECT * FROM (
  SELECT d.account_id, d.opp_id,
         {", ".join((f"coalesce(d.{c}, m.{c}) AS {c}" if c in SCORE_IMPUTED else f"d.{c}") for c in MODEL_FEATURES)},
         {_trace} AS missing_values
  FROM dedup_matrix d, (SELECT {", ".join(f"median({c}) AS {c}" for c in SCORE_IMPUTED)} FROM dedup_matrix) m) x
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES)}""",
)

# ---------------------------------------------------------------- alerts
_cte(
    "latest_scores",
    ("scores", "opps"),
    f"""SELECT date_pred, opp_id, url, round(100.0 * proba) AS proba FROM (
  SELECT s.date_pred, s.opp_id, s.url, s.proba,
         row_number() OVER (PARTITION BY s.opp_id ORDER BY s.date_pred DESC, s.proba DESC, s.url DESC) AS rn
  FROM scores s LEFT JOIN opps o ON s.opp_id = o.opp_id
  WHERE date_diff('day', CAST(s.date_pred AS DATE), DATE '{CFG.as_of}') <= {CFG.alert_max_age_days}
    AND o.lost_reason IS NULL AND o.lost_at IS NULL AND o.funds_at IS NULL
    AND o.stage NOT IN {inlist(CFG.closed_stages)} AND o.is_pro <> TRUE
    AND o.lead_owner NOT IN {inlist(CFG.alert_excluded_lead_owners)}) x
WHERE rn = 1""",
)

_cte(
    "history_merged",
    ("alert_history", "previous_alerts"),
    """SELECT date_pred, opp_id, url, proba, treatment FROM alert_history
UNION ALL
SELECT date_pred, opp_id, url, proba, treatment FROM previous_alerts WHERE treatment IS NOT NULL AND treatment <> ''""",
)


_PAIRS = [(a, b) for i, a in enumerate(MODEL_FEATURES) for b in MODEL_FEATURES[i + 1 :]]
_cte(
    "corr_wide",
    ("train_rows",),
    "SELECT "
    + ", ".join(
        f"covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0) AS c{i}" for i, (a, b) in enumerate(_PAIRS)
    )
    + " FROM train_rows",
)
_cte(
    "corr_pairs",
    ("corr_wide",),
    "SELECT unnest(["
    + ", ".join(f"struct_pack(feature_a := '{a}', feature_b := '{b}', corr := c{i})" for i, (a, b) in enumerate(_PAIRS))
    + "], recursive := true) FROM corr_wide",
)


# ---------------------------------------------------------------- scoring: the same chain over the labels of open mandates
_SCORE_CHAIN = (
    "cw", "kf", "k_last_dir", "k_last_abs", "k_last_pun", "k_days", "k_gaps", "k_exp", "k_agents", "k_pivot", "cf_raw", "cf_med",
    "call_features", "crm_m", "crm_1", "crm_3", "crm_4", "crm_5", "crm_6", "crm_7", "crm_8", "crm_clean", "crm_features", "matrix",
    "dedup_matrix", "impute_trace",
)


def _chain_on(labels: str, prefix: str, chain) -> None:
    """Definitions of the chain again, under a prefix, reading other labels and each other."""

    def again(text: str) -> str:
        text = re.sub(r"\blabels_shifted\b", labels, text)
        for name in chain:
            text = re.sub(rf"(?<=FROM ){name}\b|(?<=JOIN ){name}\b", prefix + name, text)
        # a table that follows another one after FROM
        return re.sub(rf"({prefix}cf_raw r, )cf_med\b", rf"\1{prefix}cf_med", text)

    for name in chain:
        deps, body = OA.CTES[name]
        _cte(prefix + name, tuple(prefix + d if d in chain else d.replace("labels_shifted", labels) for d in deps), again(body))


_chain_on("labels_score", "s_", _SCORE_CHAIN)

_cte(
    "labels_distinct",
    ("labels_shifted",),
    """SELECT min(opp_id) AS opp_id, account_id, ref_date, max(mandate_date) AS mandate_date, CAST(NULL AS DOUBLE) AS rating,
       CAST(NULL AS BIGINT) AS mandate_delta_days FROM labels_shifted GROUP BY account_id, ref_date""",
)
_chain_on("labels_distinct", "d_", _SCORE_CHAIN[: _SCORE_CHAIN.index("cf_raw") + 1])

_cte(
    "cw_account",
    ("call_base_account", "first_expert", "labels_score"),
    re.sub(r"\bcall_base_agent\b", "call_base_account", re.sub(r"\blabels_shifted\b", "labels_score", OA.CTES["cw"][1])),
)

_cte(
    "scored_labels",
    ("scores", "labels_train"),
    f"""SELECT s.date_pred, s.proba, coalesce(l.rating > {CFG.good_rating_above}, false) AS is_good
FROM scores s JOIN labels_train l USING (opp_id) WHERE l.rating IS NULL OR l.rating NOT IN {inlist(CFG.ambiguous_ratings)}""",
)


def _auc(rows: str, group: str) -> str:
    """Pairs counted one by one: wins and half of the ties over all pairs of a positive and a negative row."""
    on = f"USING ({group})" if group else "ON true"
    keys = f"{group}, " if group else ""
    tail = f"GROUP BY {group}" if group else ""
    sizes = f"SELECT {keys}CAST(count(*) FILTER (WHERE is_good) AS BIGINT) AS n_pos, CAST(count(*) FILTER (WHERE NOT is_good) AS BIGINT) AS n_neg FROM ({rows}) r {tail}"
    wins = f"""SELECT {keys}sum(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END) AS wins
  FROM (SELECT * FROM ({rows}) r WHERE is_good) p JOIN (SELECT * FROM ({rows}) r WHERE NOT is_good) n {on} {tail}"""
    return f"SELECT {keys}n_pos, n_neg, wins / (n_pos * n_neg) AS auc FROM ({sizes}) z LEFT JOIN ({wins}) w {on} WHERE n_pos + n_neg > 0"


def _rows(cte: str, cols: str = "*") -> tuple[list[str], str]:
    return [cte], f"SELECT {cols} FROM {cte}"


def _raw_cols(cols) -> str:
    sel = []
    for c in cols:
        sel.append(c if c in _NON_NUM else f"CAST({c} AS DOUBLE) AS {c}")
    return f"{K}, " + ", ".join(sel)


def build() -> dict[str, str]:
    from callpulse.operators.assemble import PER_CALL_FEATURES
    from callpulse.plans.catalog import CORRELATED, CRM_CLEAN_COLUMNS, RAW_VIEWS

    split = f"""SELECT {K}, is_good, is_test FROM train_rows JOIN (
  SELECT opp_id, taken <= {CFG.test_fraction} * total AS is_test FROM (
    SELECT opp_id, good, count(*) OVER (PARTITION BY good ORDER BY slot) AS taken, count(*) OVER (PARTITION BY good) AS total
    FROM (SELECT opp_id, bool_or(is_good) AS good,
                 CAST(('0x' || substr(md5(CAST(opp_id AS VARCHAR) || '|' || '{CFG.seed}'), 1, 8)) AS BIGINT) % 10000 AS slot
          FROM train_rows GROUP BY opp_id) o) r) sides USING (opp_id)"""
    q: dict[str, tuple[list[str], str]] = {
        "day_round": (["reviews"], f"SELECT review_id, review_ts, {rd('review_ts')} AS ref_day FROM reviews"),
        "floor_days": (
            ["opps"],
            f"""SELECT opp_id, {fd('mandate_signed_at', 'created_at')} AS days_to_mandate,
       {fd('compromise_at', 'created_at')} AS days_to_compromise,
       {fd('suspensive_at', 'mandate_signed_at')} AS days_mandate_to_suspensive,
       date_sub('minute', created_at, mandate_signed_at) AS minutes_to_mandate FROM opps""",
        ),
        "call_window_join": (
            ["cw"],
            f"""SELECT {K}, label_opp_id, call_id, start_time, direction, duration_s, agent, agent_norm, role,
       missed_status, absence_flag, first_expert_call, mandate_delta_days FROM cw""",
        ),
        "missed_status": _rows("missed_status"),
        "scheduled_slots": _rows("slots_agent"),
        "realised_calls": _rows("realised_agent"),
        "punctuality_by_agent": _rows("punct_agent"),
        "punctuality_by_account": _rows("punct_account"),
        "call_base_train": _rows("call_base_agent"),
        "call_base_score": _rows("call_base_account"),
        "opps_train": _rows("opps_train"),
        "opps_open": _rows("opps_open"),
        "mandates_train": _rows("mandates_train"),
        "mandates_open": _rows("mandates_open"),
        "labels_train": _rows("labels_train"),
        "labels_shifted": _rows("labels_shifted"),
        "labels_score": _rows("labels_score"),
        "crm_clean": _rows("crm_clean", ", ".join(CRM_CLEAN_COLUMNS)),
        "crm_clean_score": _rows("crm_8", ", ".join(CRM_CLEAN_COLUMNS)),
        "stage_deltas": _rows(
            "crm_features",
            f"{K}, days_r1_to_assembly, days_assembly_to_sent, days_suspensive_to_ref, days_created_to_sent, "
            "days_created_to_mandate, days_mandate_to_ref, days_sent_to_ref",
        ),
        "last_stage": _rows("crm_features", f"{K}, last_stage_at, last_stage, days_last_stage_to_ref"),
        "crm_features": _rows("crm_features", f"{K}, rating, mandate_delta_days, {CRM_FEATURES}"),
        "weighted_medians": _rows("cf_med"),
        "call_features_all": _rows("call_features"),
        "features_joined": _rows("matrix"),
        "impute_trace": _rows("impute_trace"),
        "label_is_good": _rows("label_good", f"{K}, rating, is_good"),
        "class_weights": (
            ["train_rows"],
            f"""SELECT is_good, n_class, sum(n_class) OVER () / (count(*) OVER () * n_class) AS weight
FROM (SELECT is_good, count(*) AS n_class FROM ({split}) s WHERE NOT is_test GROUP BY is_good) c""",
        ),
        "stratified_split": (["train_rows"], split),
        "correlated_features": (["corr_pairs"], "SELECT * FROM corr_pairs WHERE abs(corr) > 0.85 AND NOT isnan(corr)"),
        "review_csv_roundtrip": _rows("labels_train"),
        "latest_scores": _rows("latest_scores"),
        "alerts_ranked": _rows("latest_scores"),
        "alert_history_merge": _rows("history_merged"),
        "alerts_new": (
            ["latest_scores", "history_merged"],
            f"""SELECT date_pred, opp_id, url, proba, '' AS treatment FROM latest_scores
WHERE opp_id NOT IN (
  SELECT opp_id FROM history_merged
  WHERE {fd('(SELECT max(date_pred) FROM latest_scores)', 'date_pred')} < {CFG.alert_recent_days}
    AND opp_id IS NOT NULL)""",
        ),
        "name_fold": (
            [],
            f"SELECT conv_id, turn, {fold('text')} AS text_folded FROM conversations",
        ),
    }
    window = q["call_window_join"][1]
    q["call_window_stored"] = q["call_window_join"]
    q["call_window_score"] = (["cw_account"], window.replace("mandate_delta_days FROM cw", f"mandate_delta_days, {PUNCT} FROM cw_account"))
    q["per_call"] = (
        ["cw", "cf_raw"],
        f"""SELECT {K}, c.label_opp_id, c.call_id, c.start_time, c.{PUNCT.replace(', ', ', c.')}, {", ".join("f." + x for x in PER_CALL_FEATURES)}
FROM cw c JOIN cf_raw f USING ({K})""",
    )
    q["scoring_matrix"] = _rows("s_impute_trace")
    both = """SELECT date_pred, is_good, 'probability' AS kind, proba AS score FROM scored_labels
UNION ALL SELECT date_pred, is_good, 'prediction', CASE WHEN proba > 0.5 THEN 1.0 ELSE 0.0 END FROM scored_labels"""
    q["score_auc"] = (["scored_labels"], _auc(both, "date_pred, kind"))
    q["score_auc_total"] = (["scored_labels"], _auc("SELECT is_good, proba AS score FROM scored_labels", ""))
    q["sink_roundtrip"] = _rows("scores", "account_id, opp_id, proba, url, date_pred")
    q["latest_scores_stored"] = _rows("latest_scores")
    q["review_dates_parsed"] = (
        ["reviews"],
        """SELECT review_id, CASE WHEN review_id % 11 = 0 OR review_id % 13 = 0 THEN NULL ELSE review_ts END AS review_ts, CAST(1 AS BIGINT) AS n
FROM reviews WHERE review_id % 17 <> 0
UNION ALL SELECT -1, NULL, count(*) FROM reviews WHERE review_id % 17 = 0""",
    )
    pairs = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1 :]]
    each = ", ".join(f"struct_pack(feature_a := '{a}', feature_b := '{b}', corr := corr({a}, {b}))" for a, b in pairs)
    q["feature_correlations"] = (["cf_raw"], f"SELECT * FROM (SELECT unnest([{each}], recursive := true) FROM cf_raw) WHERE abs(corr) > 0.85 AND NOT isnan(corr)")
    from callpulse.operators.assemble import CALL_FEATURE_COLUMNS

    q["call_features_raw"] = (["cf_raw"], f"SELECT {_raw_cols(CALL_FEATURE_COLUMNS[3:])} FROM cf_raw")
    q["cells_two_days"] = q["call_features_raw"]
    q["call_features_distinct"] = (["d_cf_raw"], q["call_features_raw"][1].replace("FROM cf_raw", "FROM d_cf_raw"))
    zero = re.sub(r"m\.(\w+)\) AS", r"0.0) AS", OA.CTES["call_features"][1]).replace("cf_raw r, cf_med m", "cf_raw r")
    q["call_features_zero"] = (["cf_raw"], zero)
    for name, cols in RAW_VIEWS.items():
        q[name] = (["cf_raw"], f"SELECT {_raw_cols(cols)} FROM cf_raw")
    return {name: with_ctes(needs, body) for name, (needs, body) in q.items()}

