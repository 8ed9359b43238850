"""DuckDB SQL for each registered query, written independently of the Spark plans.

Rounding hygiene: Spark rounds half-up on the decimal value, DuckDB's
``round(double)`` works on the binary value; both sides therefore round
DECIMALs (``_r2``). Means are exact DECIMAL sums divided by counts.
"""

from __future__ import annotations

from ..operators.report import SUGGESTIONS
from ..sources.feeds import FEEDS

BYC = "user_id, period_type, start_date, end_date"
METRICS = ("readiness_score", "sleep_score", "sleep_efficiency", "steps", "calories",
           "avg_spo2_pct", "stress_high", "recovery_high")


def _r(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), {n}) AS DOUBLE)"


def _r2(x: str) -> str:
    return _r(x, 2)


def _q(s: str, c: str) -> str:
    """Exact-to-9-decimals quotient of a DECIMAL sum and a count."""
    return f"CAST({s} / {c} AS DECIMAL(38,9))"


def _mean2(x: str) -> str:
    return f"CAST(round({_q(f'sum(CAST({x} AS DECIMAL(38,9)))', f'count({x})')}, 2) AS DOUBLE)"


def _fmt1(x: str) -> str:
    return f"printf('%.1f', {_r(x, 1)})"


STAGED = """staged AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(ts AS DATE) AS partition_date
  FROM events)"""


def _s2(cond: str) -> str:
    return f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE {cond}) AS DOUBLE)"


LEGS = f"""daily AS (
  SELECT user_id, day,
    count(*) FILTER (WHERE event_type = 'click') AS n_ready,
    {_s2("event_type = 'click'")} AS readiness_score,
    count(*) FILTER (WHERE event_type = 'view') AS n_sleep,
    {_s2("event_type = 'view'")} AS sleep_score,
    max(k) FILTER (WHERE event_type = 'view') AS sleep_efficiency,
    count(*) FILTER (WHERE event_type = 'purchase') AS n_act,
    count(*) FILTER (WHERE event_type = 'purchase') AS steps,
    {_s2("event_type = 'purchase'")} AS calories,
    count(*) FILTER (WHERE event_type = 'error') AS n_spo2,
    max(value) FILTER (WHERE event_type = 'error') AS avg_spo2_pct,
    min(value) FILTER (WHERE event_type = 'error') AS breathing_disturbance_index,
    count(*) FILTER (WHERE event_type = 'signup') AS n_stress,
    {_s2("event_type = 'signup'")} AS stress_high,
    count(*) FILTER (WHERE event_type = 'signup') AS recovery_high,
    CAST(max(k) FILTER (WHERE event_type = 'signup') AS VARCHAR) AS stress_summary,
    count(*) FILTER (WHERE k >= 50) AS n_res,
    max(event_type) FILTER (WHERE k >= 50) AS resilience_level,
    {_s2("k >= 50")} AS sleep_recovery_score,
    max(value) FILTER (WHERE k >= 50) AS daytime_recovery_score,
    min(value) FILTER (WHERE k >= 50) AS resilience_stress_score
  FROM staged GROUP BY user_id, day),
l_ready AS (SELECT user_id, day, readiness_score FROM daily WHERE n_ready > 0),
l_sleep AS (SELECT user_id, day, sleep_score, sleep_efficiency FROM daily WHERE n_sleep > 0),
l_act AS (SELECT user_id, day, steps, calories FROM daily WHERE n_act > 0),
l_spo2 AS (SELECT user_id, day, avg_spo2_pct, breathing_disturbance_index FROM daily WHERE n_spo2 > 0),
l_stress AS (SELECT user_id, day, stress_high, recovery_high, stress_summary FROM daily WHERE n_stress > 0),
l_res AS (SELECT user_id, day, resilience_level, sleep_recovery_score, daytime_recovery_score,
                 resilience_stress_score FROM daily WHERE n_res > 0)"""

MART_VALUES = ("readiness_score, steps, calories, sleep_score, sleep_efficiency, avg_spo2_pct, "
               "breathing_disturbance_index, stress_high, recovery_high, stress_summary, "
               "resilience_level, sleep_recovery_score, daytime_recovery_score, "
               "resilience_stress_score")

_BASE_U = "coalesce(l_sleep.user_id, l_act.user_id, l_ready.user_id)"
_BASE_D = "coalesce(l_sleep.day, l_act.day, l_ready.day)"
MART1 = f"""mart AS (
  SELECT coalesce(l_sleep.user_id, l_act.user_id, l_ready.user_id, l_spo2.user_id, l_stress.user_id,
                  l_res.user_id) AS user_id,
         coalesce(l_sleep.day, l_act.day, l_ready.day, l_spo2.day, l_stress.day, l_res.day) AS day,
         l_ready.readiness_score, l_act.steps, l_act.calories, l_sleep.sleep_score,
         l_sleep.sleep_efficiency, l_spo2.avg_spo2_pct, l_spo2.breathing_disturbance_index,
         l_stress.stress_high, l_stress.recovery_high, l_stress.stress_summary,
         l_res.resilience_level, l_res.sleep_recovery_score, l_res.daytime_recovery_score,
         l_res.resilience_stress_score
  FROM l_ready
  FULL OUTER JOIN l_sleep ON l_sleep.user_id = l_ready.user_id AND l_sleep.day = l_ready.day
  FULL OUTER JOIN l_act ON l_act.user_id = l_ready.user_id AND l_act.day = l_ready.day
  FULL OUTER JOIN l_spo2 ON l_spo2.user_id = {_BASE_U} AND l_spo2.day = {_BASE_D}
  FULL OUTER JOIN l_stress ON l_stress.user_id = {_BASE_U} AND l_stress.day = {_BASE_D}
  FULL OUTER JOIN l_res ON l_res.user_id = {_BASE_U} AND l_res.day = {_BASE_D})"""

MART2 = f"""mart AS (
  SELECT user_id, day, {MART_VALUES}
  FROM l_ready
  FULL OUTER JOIN l_sleep USING (user_id, day)
  FULL OUTER JOIN l_act USING (user_id, day)
  FULL OUTER JOIN l_spo2 USING (user_id, day)
  FULL OUTER JOIN l_stress USING (user_id, day)
  FULL OUTER JOIN l_res USING (user_id, day))"""


def _periods(name: str, src: str) -> str:
    wk = "CAST(date_trunc('week', day) AS DATE)"
    return f"""{name} AS (
  SELECT s.*, 'weekly' AS period_type, {wk} AS start_date, {wk} + 6 AS end_date FROM {src} s
  UNION ALL
  SELECT s.*, 'monthly' AS period_type, CAST(date_trunc('month', day) AS DATE) AS start_date,
         CAST(last_day(day) AS DATE) AS end_date FROM {src} s)"""


SLEEP = """sp AS (
  SELECT user_id, event_id AS id, day, event_type AS sleep_type,
         CAST(round(value * 100) AS BIGINT) AS total_sleep_duration,
         CAST(k * 30 AS BIGINT) AS deep_sleep_duration, CAST(k * 60 AS BIGINT) AS light_sleep_duration,
         CAST((99 - k) * 30 AS BIGINT) AS rem_sleep_duration, CAST(k * 5 AS BIGINT) AS awake_time,
         CAST(round(value * 100) AS BIGINT) + CAST(k * 5 AS BIGINT) AS time_in_bed,
         k AS efficiency, value AS avg_hr, value AS avg_hrv, k AS lowest_hr
  FROM staged)"""

WORKOUTS = """wk AS (SELECT user_id, event_id AS id, day, event_type AS workout_activity,
                  value AS workout_calories FROM staged)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _mart_ctes(mart: str = "j2") -> list[str]:
    return [STAGED, LEGS, MART2 if mart == "j2" else MART1]


def _stats_ctes(mart: str = "j2") -> list[str]:
    long_parts = "\n  UNION ALL\n".join(
        f"  SELECT {BYC}, day, '{m}' AS metric, CAST({m} AS DECIMAL(38,9)) AS v, "
        f"CAST({m} AS DOUBLE) AS vd FROM per" for m in METRICS)
    return [*_mart_ctes(mart), _periods("per", "mart"), f"""spans AS (
  SELECT {BYC}, min(day) AS dmin, max(day) AS dmax FROM per GROUP BY {BYC}),
long AS (
{long_parts}),
lm AS (
  SELECT l.*, l.start_date + CAST((l.end_date - l.start_date) // 2 AS INTEGER) AS pmid,
         sp.dmin + CAST((sp.dmax - sp.dmin) // 2 AS INTEGER) AS dmid
  FROM long l JOIN spans sp USING (user_id, period_type, start_date, end_date)),
stats AS (
  SELECT {BYC}, metric, count(*) AS total_days, count(v) AS days_with_data, sum(v) AS s,
    min(vd) AS lo, max(vd) AS hi,
    sum(v) FILTER (WHERE day <= pmid) AS s1, count(v) FILTER (WHERE day <= pmid) AS c1,
    sum(v) FILTER (WHERE day > pmid) AS s2, count(v) FILTER (WHERE day > pmid) AS c2,
    sum(v) FILTER (WHERE day <= dmid) AS s1d, count(v) FILTER (WHERE day <= dmid) AS c1d,
    sum(v) FILTER (WHERE day > dmid) AS s2d, count(v) FILTER (WHERE day > dmid) AS c2d
  FROM lm GROUP BY {BYC}, metric),
st AS (
  SELECT *,
    CAST({_q('s1', 'c1')} AS DOUBLE) AS m1, CAST({_q('s2', 'c2')} AS DOUBLE) AS m2,
    CAST({_q('s1d', 'c1d')} AS DOUBLE) AS m1d, CAST({_q('s2d', 'c2d')} AS DOUBLE) AS m2d
  FROM stats),
st2 AS (
  SELECT *,
    coalesce(CASE WHEN c1 > 0 AND c2 > 0 AND m1 <> 0 THEN (m2 - m1) / m1 * 100.0 END, 0.0) AS pct,
    CASE WHEN c1d > 0 AND c2d > 0 AND m1d <> 0 THEN (m2d - m1d) / m1d * 100.0 END AS dpct,
    CAST({_q('s', 'days_with_data')} AS DOUBLE) AS mean_d,
    CASE metric WHEN 'sleep_efficiency' THEN 85.0 WHEN 'readiness_score' THEN 70.0
                WHEN 'sleep_score' THEN 70.0 WHEN 'avg_spo2_pct' THEN 95.0 END AS target
  FROM st)"""]


def _summary_sql(mart: str = "j2") -> str:
    return _with(*_stats_ctes(mart)) + f"""SELECT {BYC}, metric,
  CAST(round({_q('s', 'days_with_data')}, 2) AS DOUBLE) AS mean,
  {_r2('lo')} AS min_val, {_r2('hi')} AS max_val,
  CASE WHEN pct > 5.0 THEN 'improving' WHEN pct < -5.0 THEN 'declining' ELSE 'stable' END
    AS trend_direction,
  {_r2('pct')} AS trend_pct, days_with_data, total_days
FROM st2 WHERE days_with_data > 0"""


# The fixed texts are stated once, in the marked block of the report module.
_SUGG = {k: v for k, v in SUGGESTIONS.items() if k in METRICS}


def _alerts_sql(use_threshold: bool = True, kind: str | None = None) -> str:
    sugg = "CASE metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SUGG.items()) + \
        " ELSE 'Review this metric with your health provider' END"
    trank = "CASE metric WHEN 'sleep_efficiency' THEN 0 WHEN 'readiness_score' THEN 1 " \
            "WHEN 'sleep_score' THEN 2 WHEN 'avg_spo2_pct' THEN 3 END"
    drank = "CASE metric " + " ".join(f"WHEN '{m}' THEN {100 + i}" for i, m in enumerate(METRICS)) + " END"
    below = "(target IS NOT NULL AND mean_d < target)" if use_threshold else "FALSE"
    declined = "(dpct IS NOT NULL AND dpct < -10.0)"
    where = f"days_with_data > 0 AND ({below} OR {declined})"
    sql = _with(*_stats_ctes("j2")) + f""", al AS (
  SELECT {BYC}, metric,
    CASE WHEN {below} THEN 'threshold' WHEN {declined} THEN 'decline' END AS kind,
    CASE WHEN {below} THEN 'Below target of ' || CAST(CAST(target AS DOUBLE) AS VARCHAR)
         WHEN {declined} THEN 'Declined ' || printf('%.1f', abs({_r('dpct', 1)})) || '% over period'
    END AS reason,
    CAST(round({_q('s', 'days_with_data')}, 2) AS DOUBLE) AS current_avg,
    {sugg} AS suggestion,
    CAST(CASE WHEN {below} THEN {trank} ELSE {drank} END AS INTEGER) AS alert_rank
  FROM st2 WHERE {where})
SELECT * FROM al"""
    if kind:
        sql += f" WHERE kind = '{kind}'"
    return sql


def _per2() -> list[str]:
    return [*_mart_ctes("j2"), _periods("per", "mart")]


def _sleep_per() -> list[str]:
    return [STAGED, SLEEP, _periods("spp", "sp")]


STAGE_COLS = "SELECT event_id, user_id, day, event_type, value, k FROM staged"

_LABEL = "strftime(day, '%a %-m/%-d')"


def _title(col: str) -> str:
    return "CASE " + col + " " + " ".join(
        f"WHEN '{m}' THEN '{' '.join(w.capitalize() for w in m.split('_'))}'" for m in METRICS) + " END"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["stage_variant"] = _with(STAGED) + STAGE_COLS
    q["stage_missing_path"] = """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CAST(NULL AS INTEGER) AS missing, CAST(NULL AS INTEGER) AS missing_nested,
  CAST(NULL AS INTEGER) AS type_as_int FROM events"""
    q["explode_variant"] = """SELECT event_id, 0 AS pos, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events WHERE event_type <> 'error'
UNION ALL
SELECT event_id, 1 AS pos, CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS k
FROM events WHERE event_type <> 'error'"""
    q["mart_full_outer_chain"] = _with(*_mart_ctes("j1")) + "SELECT * FROM mart"
    q["mart_full_outer_chain_grouped"] = q["mart_full_outer_chain"]
    q["mart_full_outer_key"] = _with(*_mart_ctes("j2")) + "SELECT * FROM mart"
    q["mart_left_detail"] = _with(STAGED, SLEEP, """tm AS (
  SELECT user_id, day,
    CASE WHEN k >= 50 THEN 'earlier_bedtime' ELSE 'follow_optimal_bedtime' END AS sleep_recommendation,
    CAST(-k * 60 AS INTEGER) AS optimal_bedtime_start_offset,
    CAST(k * 60 AS INTEGER) AS optimal_bedtime_end_offset
  FROM staged WHERE event_type = 'signup')""") + """SELECT sp.*, tm.sleep_recommendation,
  tm.optimal_bedtime_start_offset, tm.optimal_bedtime_end_offset
FROM sp LEFT JOIN tm ON sp.user_id = tm.user_id AND sp.day = tm.day"""
    q["metric_summary"] = _summary_sql("j2")
    q["metric_summary_chain"] = _summary_sql("j1")
    q["trend_split_half"] = (f"SELECT {BYC}, metric, trend_direction, trend_pct FROM ("
                             + _summary_sql("j2") + ")")
    q["threshold_alerts"] = _alerts_sql(True, "threshold")
    q["decline_alerts"] = _alerts_sql(False, "decline")
    q["alerts_merged"] = _alerts_sql(True)
    bl = "\n  UNION ALL\n".join(
        [f"  SELECT {BYC}, day, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, -1.0 AS sign "
         f"FROM per WHERE {m} IS NOT NULL" for m in ("readiness_score", "sleep_score", "steps")]
        + [f"  SELECT {BYC}, day, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, {sg} AS sign "
           f"FROM spp WHERE sleep_type = 'view' AND {m} IS NOT NULL"
           for m, sg in (("avg_hrv", "-1.0"), ("lowest_hr", "1.0"))])
    q["personal_bests"] = _with(*_per2(), SLEEP, _periods("spp", "sp"), f"bl AS (\n{bl})") + \
        f"""SELECT {BYC}, metric, value, day FROM (
  SELECT *, row_number() OVER (PARTITION BY {BYC}, metric ORDER BY sign * value, day) AS rn FROM bl)
WHERE rn = 1"""

    def pct(a: str, b: str) -> str:
        return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0) * 100.0"

    def avg2(x: str) -> str:
        return _r2(f"avg({x})")
    dur = _q("sum(CAST(total_sleep_duration AS DECIMAL(38,9)))", "count(total_sleep_duration)")
    q["ratio_summary"] = _with(*_sleep_per()) + f"""SELECT {BYC}, count(*) AS nights,
  CAST(round(CAST({dur} / 3600 AS DECIMAL(38,9)), 2) AS DOUBLE) AS avg_duration_hrs,
  {_mean2('efficiency')} AS avg_efficiency, {_mean2('avg_hrv')} AS avg_hrv,
  {_mean2('avg_hr')} AS avg_hr,
  {avg2(pct('deep_sleep_duration', 'total_sleep_duration'))} AS deep_pct,
  {avg2(pct('light_sleep_duration', 'total_sleep_duration'))} AS light_pct,
  {avg2(pct('rem_sleep_duration', 'total_sleep_duration'))} AS rem_pct,
  {avg2(pct('awake_time', 'time_in_bed'))} AS awake_pct
FROM spp WHERE sleep_type = 'view' GROUP BY {BYC}"""
    q["activity_summary"] = _with(STAGED, WORKOUTS, _periods("wkp", "wk"), f"""pa AS (
  SELECT {BYC}, workout_activity AS activity, count(*) AS sessions,
         sum(CAST(workout_calories AS DECIMAL(38,9))) AS cal
  FROM wkp GROUP BY {BYC}, workout_activity)""") + f"""SELECT {BYC}, activity, sessions,
  CAST(sum(sessions) OVER w AS BIGINT) AS total_count,
  CAST(coalesce(sum(cal) OVER w, 0) AS DOUBLE) AS total_calories
FROM pa WINDOW w AS (PARTITION BY {BYC})"""
    gate_cond = "count(readiness_score) < 2 AND count(sleep_score) < 2"
    q["sufficiency_gate"] = _with(*_per2()) + f"""SELECT {BYC},
  count(readiness_score) AS n_readiness_score, count(sleep_score) AS n_sleep_score,
  CASE WHEN {gate_cond} THEN 'skipped' ELSE 'ok' END AS status,
  CASE WHEN {gate_cond} THEN printf('Need at least 2 non-null rows for readiness_score or sleep_score, got %d and %d',
    count(readiness_score), count(sleep_score)) END AS reason
FROM per GROUP BY {BYC}"""
    q["report_gated_summary"] = _with(*_per2(), f"""okg AS (
  SELECT {BYC} FROM per GROUP BY {BYC}
  HAVING NOT ({gate_cond}))""") + f"""SELECT s.* FROM ({_summary_sql('j2')}) s
  SEMI JOIN okg USING (user_id, period_type, start_date, end_date)"""
    wk = "CAST(date_trunc('week', day) AS DATE)"
    q["period_weekly"] = f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders)
SELECT 'weekly' AS period_type, {wk} AS start_date, {wk} + 6 AS end_date, count(*) AS n_orders,
  CAST(sum(CAST(o_totalprice AS DECIMAL(38,9))) AS DOUBLE) AS total_price,
  min(day) AS first_day, max(day) AS last_day, {wk} - 7 AS prev_start, {wk} - 1 AS prev_end
FROM o GROUP BY {wk}"""
    mo = "CAST(date_trunc('month', day) AS DATE)"
    q["period_monthly"] = f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders)
SELECT 'monthly' AS period_type, {mo} AS start_date, CAST(last_day({mo}) AS DATE) AS end_date,
  count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(38,9))) AS DOUBLE) AS total_price,
  min(day) AS first_day, max(day) AS last_day,
  CAST({mo} - INTERVAL 1 MONTH AS DATE) AS prev_start,
  CAST(last_day(CAST({mo} - INTERVAL 1 MONTH AS DATE)) AS DATE) AS prev_end
FROM o GROUP BY {mo}"""
    q["rolling_mean3"] = _with(*_sleep_per()) + f"""SELECT {BYC}, day, id, idx, label, value, rolling_mean FROM (
  SELECT {BYC}, day, id, row_number() OVER w - 1 AS idx,
    count(*) OVER (PARTITION BY {BYC}) AS n, {_LABEL} AS label, CAST(avg_hrv AS DOUBLE) AS value,
    round(avg(avg_hrv) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_mean
  FROM spp WHERE sleep_type = 'view' AND avg_hrv IS NOT NULL
  WINDOW w AS (PARTITION BY {BYC} ORDER BY day, id)) WHERE n >= 2"""
    q["downsample_nth"] = _with(*_per2()) + f"""SELECT {BYC}, day, idx, n FROM (
  SELECT {BYC}, day, row_number() OVER (PARTITION BY {BYC} ORDER BY day) - 1 AS idx,
         count(*) OVER (PARTITION BY {BYC}) AS n FROM per)
WHERE n <= 10 OR idx % greatest(n // 7, 2) = 0 OR idx = n - 1"""
    base_scores = f"""b AS (
  SELECT {BYC}, day, readiness_score, sleep_score,
    row_number() OVER (PARTITION BY {BYC} ORDER BY day) - 1 AS idx,
    count(*) OVER (PARTITION BY {BYC}) AS n,
    greatest(count(readiness_score) OVER (PARTITION BY {BYC}),
             count(sleep_score) OVER (PARTITION BY {BYC})) AS anyv,
    {_LABEL} AS label
  FROM per)"""
    q["series_scores"] = _with(*_per2(), base_scores) + f"""SELECT {BYC}, day, idx, label, 'Readiness' AS line,
  CAST(readiness_score AS DOUBLE) AS value FROM b WHERE n >= 2 AND anyv > 0 AND readiness_score IS NOT NULL
UNION ALL
SELECT {BYC}, day, idx, label, 'Sleep' AS line, CAST(sleep_score AS DOUBLE) AS value
FROM b WHERE n >= 2 AND anyv > 0 AND sleep_score IS NOT NULL"""
    q["series_target"] = _with(*_per2()) + f"""SELECT {BYC}, day, idx, label, value, target, met,
  CASE WHEN met THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.6 AS DOUBLE) END AS alpha FROM (
  SELECT {BYC}, day, row_number() OVER (PARTITION BY {BYC} ORDER BY day) - 1 AS idx,
    {_LABEL} AS label, coalesce(CAST(steps AS DOUBLE), 0.0) AS value, CAST(2.0 AS DOUBLE) AS target,
    coalesce(CAST(steps AS DOUBLE), 0.0) >= 2.0 AS met,
    count(steps) OVER (PARTITION BY {BYC}) AS nn
  FROM per) WHERE nn > 0"""
    q["series_stacked"] = _with(*_sleep_per()) + f"""SELECT {BYC}, day, id,
  row_number() OVER (PARTITION BY {BYC} ORDER BY day, id) - 1 AS idx,
  {_LABEL} AS label,
  coalesce(deep_sleep_duration / 3600, 0.0) AS deep_h,
  coalesce(light_sleep_duration / 3600, 0.0) AS light_h,
  coalesce(rem_sleep_duration / 3600, 0.0) AS rem_h,
  coalesce(awake_time / 3600, 0.0) AS awake_h,
  coalesce(deep_sleep_duration / 3600, 0.0) AS light_bottom,
  coalesce(deep_sleep_duration / 3600, 0.0) + coalesce(light_sleep_duration / 3600, 0.0) AS rem_bottom,
  coalesce(deep_sleep_duration / 3600, 0.0) + coalesce(light_sleep_duration / 3600, 0.0)
    + coalesce(rem_sleep_duration / 3600, 0.0) AS awake_bottom
FROM spp WHERE sleep_type = 'view'"""
    q["chart_counts"] = _with(*_per2(), SLEEP, _periods("spp", "sp"), base_scores) + f""", charts AS (
  SELECT DISTINCT {BYC}, 'daily_scores' AS chart FROM b
    WHERE n >= 2 AND anyv > 0 AND (readiness_score IS NOT NULL OR sleep_score IS NOT NULL)
  UNION ALL
  SELECT {BYC}, 'steps' FROM per GROUP BY {BYC} HAVING count(steps) > 0
  UNION ALL
  SELECT {BYC}, 'sleep_stages' FROM spp WHERE sleep_type = 'view' GROUP BY {BYC}
  UNION ALL
  SELECT {BYC}, 'hrv_trend' FROM spp WHERE sleep_type = 'view' AND avg_hrv IS NOT NULL
    GROUP BY {BYC} HAVING count(*) >= 2)
SELECT {BYC}, count(*) AS charts FROM charts GROUP BY {BYC}"""
    q["report_display"] = f"""SELECT {BYC}, metric, {_title('metric')} AS label,
  {_fmt1('mean')} AS mean_text,
  {_fmt1('max_val')} AS max_text, {_fmt1('min_val')} AS min_text,
  CASE trend_direction WHEN 'improving' THEN '▲' WHEN 'declining' THEN '▼' ELSE '▶' END AS arrow,
  {_fmt1('abs(trend_pct)')} || '%' AS pct_text,
  CAST(days_with_data AS VARCHAR) || '/' || CAST(total_days AS VARCHAR) AS days_text,
  CASE WHEN period_type = 'weekly' THEN 'Weekly' ELSE 'Monthly' END || ' Health Report: '
    || strftime(start_date, '%b %d') || ' - ' || strftime(end_date, '%b %d, %Y') AS subject,
  strftime(start_date, '%B %d') || ' — ' || strftime(end_date, '%B %d, %Y') AS header,
  strftime(start_date, '%A, %b %d') AS start_label,
  strftime(end_date, '%b %d') AS end_short, strftime(end_date, '%b %d, %Y') AS end_long
FROM ({_summary_sql('j2')})"""
    best_titles = {"readiness_score": "Readiness Score", "sleep_score": "Sleep Score", "steps": "Steps",
                   "avg_hrv": "Avg Hrv", "lowest_hr": "Lowest Hr"}
    title = "CASE metric " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in best_titles.items()) + " END"
    q["bests_display"] = f"""SELECT {BYC}, metric,
  {title} || ': ' || {_fmt1('value')} || ' on ' || strftime(day, '%A, %b %d') AS line
FROM ({q['personal_bests']})"""
    q["latest_by"] = """SELECT user_id, event_id, event_type, value, ts_us FROM (
  SELECT user_id, event_id, event_type, value, epoch_us(ts) AS ts_us,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""
    for name in ("upsert_idempotent", "backfill_range", "stream_land"):
        q[name] = q["stage_variant"]
    nn_cols = ("event_id", "user_id", "day", "event_type", "k", "note", "partition_date")
    q["not_null_audit"] = _with(STAGED, "s2 AS (SELECT *, CAST(NULL AS VARCHAR) AS note FROM staged)") + \
        "\nUNION ALL\n".join(
            f"SELECT 'stg_events' AS model, '{c}' AS \"column\", count(*) AS rows, "
            f"count(*) - count({c}) AS failures, count(*) = count({c}) AS passed FROM s2"
            for c in nn_cols)
    q["completeness"] = _with(*_mart_ctes("j2")) + "\nUNION ALL\n".join(
        f"SELECT count(*) AS total_rows, '{m}' AS \"column\", count({m}) AS non_null, "
        f"count(*) - count({m}) AS nulls FROM mart" for m in METRICS)
    q["coverage"] = _with(STAGED) + """SELECT event_type, min(partition_date) AS first_day,
  max(partition_date) AS last_day, count(DISTINCT partition_date) AS days, count(*) AS rows
FROM staged GROUP BY event_type"""
    from .queries import TABLES
    q["union_counts"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
    def grid(days: int, grp: str = "") -> str:
        return f"""WITH cnt AS (SELECT event_type AS feed, CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY ALL),
feeds AS (SELECT DISTINCT feed, TRUE AS there FROM cnt UNION ALL SELECT 'refund', FALSE),
days AS (SELECT (SELECT max(CAST(ts AS DATE)) FROM events) - CAST(i AS INTEGER) AS day FROM range({days}) r(i))
SELECT f.feed, d.day, CAST(coalesce(c.rows, 0) AS BIGINT) AS rows, {grp}
  CASE WHEN NOT there THEN 'missing' WHEN coalesce(c.rows, 0) > 0 THEN 'ok' ELSE 'empty' END AS status
FROM feeds f CROSS JOIN days d LEFT JOIN cnt c ON c.feed = f.feed AND c.day = d.day"""
    q["feed_day_grid"] = grid(32)
    q["single_day_audit"] = grid(4, "CASE WHEN f.feed IN ('click', 'error', 'refund') THEN 'problem' ELSE 'control' END AS grp,")
    q["reconcile"] = """WITH e AS (SELECT CAST(ts AS DATE) AS partition_date, event_id AS id FROM events),
r AS (SELECT * FROM e UNION ALL SELECT * FROM e WHERE id % 5 = 0),
s AS (SELECT * FROM e WHERE id % 7 <> 0
      UNION ALL SELECT partition_date, id + 1000000000 FROM e WHERE id % 11 = 0),
rn AS (SELECT partition_date, CASE WHEN id % 13 <> 0 THEN id END AS id, count(*) AS n FROM r GROUP BY ALL),
sn AS (SELECT partition_date, CASE WHEN id % 13 <> 0 THEN id END AS id, count(*) AS n FROM s GROUP BY ALL),
j AS (SELECT coalesce(rn.partition_date, sn.partition_date) AS partition_date, coalesce(rn.n, 0) AS a, coalesce(sn.n, 0) AS b
      FROM rn FULL OUTER JOIN sn ON rn.partition_date = sn.partition_date AND rn.id IS NOT DISTINCT FROM sn.id)
SELECT partition_date, CAST(sum(a) AS BIGINT) AS raw_rows, CAST(sum(b) AS BIGINT) AS staged_rows,
  CAST(sum(least(a, b)) AS BIGINT) AS matched, CAST(sum(greatest(a - b, 0)) AS BIGINT) AS missing_in_staged,
  CAST(sum(greatest(b - a, 0)) AS BIGINT) AS extra_in_staged
FROM j GROUP BY ALL"""
    q["reconcile_tree"] = q["reconcile"]
    q["reconcile_tree_equal_days"] = """SELECT partition_date, count(*) AS raw_rows, count(*) FILTER (WHERE kept) AS staged_rows,
  count(*) FILTER (WHERE kept) AS matched, count(*) FILTER (WHERE NOT kept) AS missing_in_staged, CAST(0 AS BIGINT) AS extra_in_staged
FROM (SELECT CAST(ts AS DATE) AS partition_date, day(CAST(ts AS DATE)) % 2 = 1 OR event_id % 7 <> 0 AS kept FROM events) GROUP BY ALL"""
    q["row_count_checks"] = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, TRUE AS \"exists\", count(*) AS row_count, "
        f"CASE WHEN count(*) = 0 THEN 'WARN' END AS severity, TRUE AS passed, "
        f"CASE WHEN count(*) = 0 THEN 'Table {t} exists but has no rows.' END AS description FROM {t}"
        for t in TABLES)
    q["key_null_counts"] = _with(*_mart_ctes("j2")) + """SELECT count(*) AS rows,
  count(user_id) AS user_id_non_null, count(day) AS day_non_null,
  count(*) - count(user_id) AS user_id_nulls, count(*) - count(day) AS day_nulls FROM mart"""
    q["feed_coverage"] = "WITH grid AS (" + q["feed_day_grid"] + """)
SELECT feed, CAST(sum(rows) AS BIGINT) AS rows, count(*) FILTER (WHERE rows > 0) AS days_with_rows,
  CASE WHEN sum(rows) = 0 THEN 'OK but no data' ELSE '' END AS note
FROM grid GROUP BY feed"""
    q["flatten_tags"] = """SELECT event_id, 0 AS pos, event_type AS tag FROM events
UNION ALL
SELECT event_id, 1 AS pos, 'k' || json_extract_string(props, '$.k') AS tag FROM events"""
    q["reconcile_checksum"] = """WITH e AS (SELECT CAST(ts AS DATE) AS partition_date, event_id AS id,
  day(CAST(ts AS DATE)) % 2 = 1 OR event_id % 7 <> 0 AS kept FROM events)
SELECT partition_date, count(*) AS raw_rows, count(*) FILTER (WHERE kept) AS staged_rows, bool_and(kept) AS equal
FROM e GROUP BY ALL"""
    q["trailing_daily_sum"] = """SELECT event_type, CAST(ts AS DATE) AS day,
  CAST(sum(CAST(value AS DECIMAL(38,9))) AS DOUBLE) AS total, count(*) AS rows
FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
GROUP BY ALL"""
    for name, spec in FEEDS.items():
        q[f"stage_{name}"] = f"SELECT {', '.join(f'{x} AS {c}' for c, x in _feed_columns(spec).items())} FROM e".join(
            ["WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)\n", ""])
    q["not_null_pairs"] = "WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)\n" + \
        "\nUNION ALL\n".join(
            f"SELECT 'stg_{spec.name}' AS model, '{c}' AS \"column\", count(*) AS rows, count(*) - count({x}) AS failures, "
            f"count(*) = count({x}) AS passed FROM e"
            for spec in FEEDS.values() for c, x in _feed_columns(spec).items() if c in spec.not_null)
    q["not_null_observed"] = q["not_null_pairs"]
    with_k = """WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CASE WHEN event_id % 17 = 0 THEN 'not one JSON document' WHEN event_id % 19 = 0 THEN 'not an object' END AS reason FROM events)
"""
    landed = []
    for i, spec in enumerate(FEEDS.values()):
        good, columns = f"FROM e WHERE event_id % {len(FEEDS)} = {i} AND reason IS NULL", _feed_columns(spec)
        landed.append(f"SELECT '{spec.name}' AS feed, 'rows' AS item, count(*) AS n {good}")
        landed += [f"SELECT '{spec.name}' AS feed, 'null {c}' AS item, count(*) - count({columns.get(c, '1')}) AS n {good}"
                   for c in spec.not_null]
        landed.append(f"SELECT '{spec.name}' AS feed, reason AS item, count(*) AS n FROM e "
                      f"WHERE event_id % {len(FEEDS)} = {i} AND reason IS NOT NULL GROUP BY reason")
    q["land_all_feeds"] = with_k + "\nUNION ALL\n".join(landed)
    q["stream_compact"] = q["stream_land"]
    plain_legs = (STAGED, LEGS.replace("l_ready AS", "l_ready0 AS").replace("l_sleep AS", "l_sleep0 AS"),
        "l_ready AS (SELECT user_id, day, value AS readiness_score FROM staged WHERE event_type = 'click')",
        "l_sleep AS (SELECT user_id, day, value AS sleep_score, k AS sleep_efficiency FROM staged WHERE event_type = 'view')")
    q["mart_duplicates_join"] = _with(*plain_legs, MART1) + "SELECT * FROM mart"
    q["mart_duplicates_product"] = q["mart_duplicates_join"]
    q["mart_key_duplicates"] = _with(*plain_legs, MART2) + "SELECT * FROM mart"
    asked = """asked AS (SELECT user_id, min(day) AS a, max(day) AS z FROM mart GROUP BY user_id),
per AS (SELECT mart.*, period_type, start_date, end_date FROM mart JOIN (
  SELECT user_id, 'first' AS period_type, a AS start_date, a + 9 AS end_date FROM asked
  UNION ALL SELECT user_id, 'early', a + 5, a + 40 FROM asked UNION ALL SELECT user_id, 'all', a - 3, z FROM asked
  UNION ALL SELECT user_id, 'late', z - 2, z + 30 FROM asked) p ON mart.user_id = p.user_id AND day BETWEEN start_date AND end_date)"""
    q["report_requested_periods"] = _summary_sql("j2").replace(_periods("per", "mart"), asked)
    q["report_one_period"] = f"SELECT * FROM ({_summary_sql('j2')}) WHERE period_type = 'weekly' AND start_date = DATE '2024-01-08'"
    gated = lambda sql: f"SELECT s.* FROM ({sql}) s SEMI JOIN okg USING (user_id, period_type, start_date, end_date)"
    okg = f"""okg AS (SELECT {BYC} FROM per GROUP BY {BYC} HAVING NOT ({gate_cond}))"""

    def long(part: str, sql: str, item: str, value: str, text: str) -> str:
        return f"SELECT {BYC}, '{part}' AS part, {item} AS item, CAST({value} AS DOUBLE) AS value, CAST({text} AS VARCHAR) AS text FROM ({sql})"
    pieces = [long("gate", q["sufficiency_gate"], f"'{m}'", f"n_{m}", "status") for m in ("readiness_score", "sleep_score")]
    pieces += [long("metric_summaries", gated(_summary_sql("j2")), "metric", "mean", "trend_direction"),
               long("personal_bests", gated(q["personal_bests"]), "metric", "value", "day"),
               long("areas_to_improve", gated(_alerts_sql(True)), "metric", "current_avg", "reason"),
               long("workout_summary", gated(q["activity_summary"]), "activity", "sessions", "NULL")]
    pieces += [long("sleep_summary", gated(q["ratio_summary"]), f"'{f}'", f, "NULL") for f in (
        "nights", "avg_duration_hrs", "avg_efficiency", "avg_hrv", "avg_hr", "deep_pct", "light_pct", "rem_pct", "awake_pct")]
    q["report_full"] = _with(*_per2(), okg) + "\nUNION ALL\n".join(pieces)
    q["report_from_states"] = q["report_full"]

    def f0(x: str) -> str:
        return f"printf('%.0f', {_r(x, 0)})"
    q["sleep_display"] = f"""SELECT {BYC}, {_fmt1('avg_duration_hrs')} || 'h' AS duration, {f0('avg_efficiency')} || '%' AS efficiency,
  {_fmt1('avg_hrv')} || ' ms' AS hrv, {_fmt1('avg_hr')} || ' bpm' AS heart_rate,
  concat_ws(' / ', {f0('deep_pct')} || '%', {f0('light_pct')} || '%', {f0('rem_pct')} || '%', {f0('awake_pct')} || '%') AS stages
FROM ({q['ratio_summary']})"""
    q["workout_display"] = f"""SELECT {BYC}, activity, upper(activity[1]) || activity[2:] || ': ' || sessions || ' sessions' AS line,
  total_count || ' sessions' AS total, {f0('total_calories')} AS calories FROM ({q['activity_summary']})"""
    q["areas_display"] = f"""SELECT {BYC}, metric, {_title('metric')} AS label, '(avg: ' || {_fmt1('current_avg')} || ')' AS avg_text,
  reason, suggestion FROM ({q['alerts_merged']})"""
    q["activity_map"] = _with(STAGED, WORKOUTS, _periods("wkp", "wk"), f"""pa AS (
  SELECT {BYC}, CASE WHEN workout_activity IN ('error', 'signup') THEN '' ELSE workout_activity END AS a, count(*) AS n
  FROM wkp GROUP BY ALL)""") + f"""SELECT {BYC}, CAST(sum(n) AS BIGINT) AS total_count,
  string_agg(a || '=' || n, ',' ORDER BY a) AS sessions FROM pa GROUP BY {BYC}"""
    q["rolling_mean3_range"], q["series_stacked_range"] = q["rolling_mean3"], q["series_stacked"]
    chart = lambda name, key, line, value: (
        f"SELECT {BYC}, '{name}' AS chart, {line} AS line, day, idx, label, {value} AS value FROM ({q[key]})")
    q["charts_long"] = "\nUNION ALL\n".join([
        chart("daily_scores", "series_scores", "line", "value"), chart("steps", "series_target", "'steps'", "value"),
        *[chart("sleep_stages", "series_stacked", f"'{x}'", f"{x}_h") for x in ("deep", "light", "rem", "awake")],
        chart("hrv_trend", "rolling_mean3", "'value'", "value"),
        chart("hrv_trend", "rolling_mean3", "'rolling_mean'", "rolling_mean")])
    q["land_envelope_files"] = q["stage_variant"]
    q["detail_null_counts"] = f"""SELECT count(*) AS rows, count(i) AS id_non_null, count(day) AS day_non_null,
  count(*) - count(i) AS id_nulls, count(*) - count(day) AS day_nulls
FROM (SELECT day, CASE WHEN id % 13 <> 0 THEN id END AS i FROM ({q['mart_left_detail']}))"""
    q["row_count_outcomes"] = """SELECT 'events' AS table_name, TRUE AS "exists", count(*) AS row_count,
  CASE WHEN count(*) = 0 THEN 'WARN' END AS severity, TRUE AS passed,
  CASE WHEN count(*) = 0 THEN 'Table events exists but has no rows.' END AS description FROM events
UNION ALL SELECT 'no_rows', TRUE, 0, 'WARN', TRUE, 'Table no_rows exists but has no rows.'
UNION ALL SELECT 'no_table', FALSE, 0, 'WARN', TRUE, 'Table no_table does not exist yet.'"""
    q["request_days"] = "\nUNION ALL\n".join(
        f"SELECT '{x}' AS endpoint, CAST(ts AS DATE) AS day, count(*) AS rows FROM events "
        "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY ALL"
        for x in ("daily_activity", "daily_sleep"))
    return q


def _feed_columns(spec) -> dict[str, str]:
    """Staged column -> SQL of the planted feed records (see ``plans.events.feed_records``)."""
    paths = list(dict.fromkeys(c.path for c in spec.columns))
    out = {}
    for c in spec.columns:
        j = paths.index(c.path) + 1
        if c.path == "tags":
            v = """'["' || event_type || '","k' || k || '"]'"""
        elif c.type == "date":
            v = "CAST(ts AS DATE)"
        elif c.path == "timestamp":
            v = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-07:00'"
        else:
            v = {"int": f"CAST(k + {j} AS INTEGER)", "double": f"value + {j}", "string": f"event_type || '_{j}'"}[c.type]
        out[c.alias] = f"CASE WHEN k % 10 <> {j % 10} THEN {v} END"
    out["partition_date"] = "CAST(ts AS DATE)"
    return out
