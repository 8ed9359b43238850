"""Period reports for every entity and period in one job.

``by`` is the grouping of one report: entity keys plus the period columns
(``period_type``, ``start_date``, ``end_date`` from ``assign_periods``).

Summaries are one wide, partially aggregated pass per group; the few result rows are
unpivoted into (metric, value). Alerts also need the span of days present, so their
statistics take three steps:

1. partial aggregate per (by, day) -- map-side combine, so an entity holding a
   third of all rows ships at most one row per day and period;
2. the data span (first/last day) per (by) as a window over those daily rows
   (bounded by the days of a period);
3. one wide aggregation per (by), which reuses the partitioning of step 2, unpivoted.

Means are exact for fixed-point columns (see ``functions.exact``); thresholds compare
the unrounded mean, outputs are rounded half-up to 2 decimals.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import midpoint, period_bounds
from ..functions.display import below_target_reason, declined_reason
from ..functions.exact import DEC, dec, fixed_columns, mean_of, round2, summable
from ..session import stored

# Report metrics, targets, trend and alert limits, suggestions.
WELLNESS_METRICS = (
    "readiness_score", "sleep_score", "sleep_efficiency", "steps", "calories", "avg_spo2_pct",
    "stress_high", "recovery_high",
)
METRIC_THRESHOLDS = {
    "sleep_efficiency": 85.0,
    "readiness_score": 70.0,
    "sleep_score": 70.0,
    "avg_spo2_pct": 95.0,
}
TREND_THRESHOLD_PCT = 5.0
DECLINE_ALERT_PCT = 10.0
SUGGESTIONS = {
    "sleep_efficiency": "Consider consistent bedtime and limiting screen time before bed",
    "readiness_score": "Focus on recovery days and stress management techniques",
    "sleep_score": "Prioritize sleep hygiene: dark room, cool temperature, regular schedule",
    "avg_spo2_pct": "Monitor breathing patterns and consider consulting a physician",
    "steps": "Try adding a short walk after meals to increase daily movement",
    "calories": "Review activity levels and ensure adequate energy expenditure",
    "stress_high": "Incorporate relaxation practices such as meditation or deep breathing",
    "recovery_high": "Allow more rest between intense training sessions",
    "avg_hrv": "Focus on aerobic fitness and stress reduction to improve HRV",
}
DEFAULT_SUGGESTION = "Review this metric with your health provider"
GATE_REASON = "Need at least {min_rows} non-null rows for {a} or {b}, got %d and %d"
BEST_WELLNESS = (("readiness_score", "max"), ("sleep_score", "max"), ("steps", "max"))
BEST_SLEEP = (("avg_hrv", "max"), ("lowest_hr", "min"))
LONG_SLEEP = "long_sleep"
MIN_SCORE_ROWS = 2

PERIOD = ("period_type", "start_date", "end_date")


# ---- periods ----------------------------------------------------------------

def assign_periods(df: DataFrame, period_types: Sequence[str] = ("weekly", "monthly"),
                   day: str = "day") -> DataFrame:
    """Add ``period_type, start_date, end_date``: one copy of a row per period type.

    Every row belongs to exactly one week (Mon-Sun) and one calendar month, so
    all report periods are formed by a projection, not a range join.
    """
    structs = []
    for pt in period_types:
        s, e = period_bounds(day, pt)
        structs.append(F.struct(F.lit(pt).alias("period_type"), s.alias("start_date"),
                                e.alias("end_date")))
    return df.select("*", F.inline(F.array(*structs)))


def with_period(df: DataFrame, period_type: str, start: dt.date, end: dt.date,
                day: str = "day") -> DataFrame:
    """One requested period: the inclusive slice plus literal period columns."""
    return (df.where(F.col(day).between(F.lit(start), F.lit(end)))
            .withColumn("period_type", F.lit(period_type))
            .withColumn("start_date", F.lit(start))
            .withColumn("end_date", F.lit(end)))


#: Days of a bucket that rows and requested periods meet in.
BUCKET_DAYS = 32


def requested_periods(df: DataFrame, periods: DataFrame, keys: Sequence[str] = (), day: str = "day",
                      bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """The rows of every requested period: ``periods`` (keys, period_type, start_date, end_date), both ends included.

    Periods may be of any length, overlap and differ by entity; without ``keys`` they hold for all rows. A period
    is listed under each bucket of ``bucket_days`` days that it touches, so rows meet only periods near them in an
    equality join on (keys, bucket): its groups are bounded by an entity's rows of so many days, and AQE splits a
    skewed one. A row comes once per period that holds its day; equal requests count once, one that ends before it
    starts holds nothing. NULL keys and days match no period.
    """
    def bucket(c: Column) -> Column:
        return F.floor(F.datediff(c, F.lit(dt.date(1970, 1, 1))) / bucket_days)

    wanted = periods.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *PERIOD).distinct().where("start_date <= end_date")
    wanted = wanted.withColumn("_bucket", F.explode(F.sequence(bucket(F.col("start_date")), bucket(F.col("end_date")))))
    rows = df.withColumn("_at", bucket(F.col(day)))
    same = F.col("_at") == F.col("_bucket")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    met = rows.join(wanted, same & F.col(day).between(F.col("start_date"), F.col("end_date")))
    return met.select(*df.columns, *PERIOD)


def _lit_map(d: Mapping[str, object], value_type: str) -> Column:
    """A literal map (JVM-side lookup, no join); typed even when empty."""
    if not d:
        return F.lit(None).cast(f"map<string,{value_type}>")
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv]).cast(f"map<string,{value_type}>")


def _as_col(x: Column | str | dt.date) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, dt.date):
        return F.lit(x)
    return F.col(x)


# ---- shared metric statistics -------------------------------------------------

def metric_stats(df: DataFrame, by: Sequence[str] = PERIOD,
                 metrics: Sequence[str] = WELLNESS_METRICS, day: str = "day",
                 start: Column | str | dt.date = "start_date",
                 end: Column | str | dt.date = "end_date", data_split: bool = True,
                 fixed: Sequence[str] = ()) -> DataFrame:
    """Per (by, metric): row and value counts, mean, min, max, and the means and counts
    of both halves split at the period midpoint and (with ``data_split``) at the
    midpoint of the first and last day present.

    Aggregates per group, whose few result rows are unpivoted; input rows
    are never copied per metric. With ``data_split`` a per-(by, day) aggregate comes
    first, so the data span is a window over at most one row per day. Metrics absent
    from ``df`` are skipped. ``start``/``end`` give the period (columns in ``by`` or
    literal dates); ``fixed`` declares double metrics with at most 9 decimals.
    """
    metrics = [m for m in metrics if m in df.columns]
    if not metrics:
        raise ValueError("none of the metrics is present")
    by = list(by)
    exact = fixed_columns(df.select(*metrics), fixed)
    bounds = {"_pstart": start, "_pend": end}
    extra = [_as_col(x).alias(n) for n, x in bounds.items() if not (isinstance(x, str) and x in by)]
    pcol = {n: F.col(x) if isinstance(x, str) and x in by else F.col(n) for n, x in bounds.items()}
    rows = df.select(*by, day, *extra, *[summable(m, exact).alias(f"_v{i}") for i, m in enumerate(metrics)])
    pcols = [c for c in bounds if c in rows.columns]
    if not data_split:
        return _wide_stats(rows, by, metrics, day, pcol, pcols)
    days = rows.groupBy(*by, *pcols, day).agg(F.count(F.lit(1)).alias("_n"), *[
        x for i in range(len(metrics)) for x in partials(F.col(f"_v{i}"), i)])
    return _wide_stats(days, by, metrics, day, pcol, pcols, of_days=True)


def partials(value: Column, i: int) -> list[Column]:
    """The mergeable part of a metric's statistics: sum, count, least and greatest value (columns ``_s{i}`` ...)."""
    return [F.sum(value).alias(f"_s{i}"), F.count(value).alias(f"_c{i}"),
            F.min(value).alias(f"_lo{i}"), F.max(value).alias(f"_hi{i}")]


def stats_of_days(days: DataFrame, by: Sequence[str], metrics: Sequence[str], day: str = "day",
                  start: str = "start_date", end: str = "end_date") -> DataFrame:
    """``metric_stats`` from rows that are already one per (by, day): ``_n`` and the ``partials`` of each metric."""
    return _wide_stats(days, by, metrics, day, {"_pstart": F.col(start), "_pend": F.col(end)}, [], of_days=True)


def _wide_stats(rows: DataFrame, by: Sequence[str], metrics: Sequence[str], day: str, pcol: Mapping[str, Column],
                pcols: Sequence[str], of_days: bool = False) -> DataFrame:
    """One wide aggregate per group, unpivoted. ``rows`` hold values or, ``of_days``, partials of a day each."""
    d = F.col(day)
    early = d <= midpoint(pcol["_pstart"], pcol["_pend"])
    if of_days:
        return _stats_of_halves(rows, by, metrics, day, early, pcols)
    parts, value = range(len(metrics)), lambda i: F.col(f"_v{i}")
    count = lambda i: F.col(f"_v{i}").isNotNull().cast("long")
    aggs = [F.count(F.lit(1)).alias("total_days")]
    for i in parts:
        aggs += [F.sum(value(i)).alias(f"s{i}"), F.sum(count(i)).alias(f"c{i}"),
                 F.min(value(i)).cast("double").alias(f"lo{i}"), F.max(value(i)).cast("double").alias(f"hi{i}")]
        for half, cond in (("1", early), ("2", ~early)):
            aggs += [F.sum(F.when(cond, value(i))).alias(f"s{half}_{i}"),
                     F.coalesce(F.sum(F.when(cond, count(i))), F.lit(0)).alias(f"c{half}_{i}")]
    wide = rows.groupBy(*by, *pcols).agg(*aggs)
    long = F.array(*[F.struct(
        F.lit(m).alias("metric"), F.col(f"c{i}").alias("days_with_data"),
        mean_of(F.col(f"s{i}"), F.col(f"c{i}")).alias("mean"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"),
        *[x for half in "12" for x in (
            mean_of(F.col(f"s{half}_{i}"), F.col(f"c{half}_{i}")).alias(f"m{half}"),
            F.col(f"c{half}_{i}").alias(f"c{half}"))]) for i, m in enumerate(metrics)])
    return wide.select(*by, "total_days", F.inline(long))


def _stats_of_halves(days: DataFrame, by: Sequence[str], metrics: Sequence[str], day: str, early: Column,
                     pcols: Sequence[str]) -> DataFrame:
    """The statistics with both splits from partials of a day each.

    A day is in one half of the period and one of the data, so days are first merged by these: at most four rows a
    group and one sum a metric. Only they are unpivoted, and each metric's rows give the total and the halves. All
    of it is dealt out as the window is, and no aggregate is too wide for generated code.
    """
    w = Window.partitionBy(*by)
    days = days.withColumn("_dmin", F.min(day).over(w)).withColumn("_dmax", F.max(day).over(w))
    days = days.withColumn("_e", early).withColumn("_ed", F.col(day) <= midpoint(F.col("_dmin"), F.col("_dmax")))
    parts = range(len(metrics))
    halves = days.groupBy(*by, *pcols, "_e", "_ed").agg(F.sum("_n").alias("_n"), *[
        x for i in parts for x in (
            F.sum(f"_s{i}").alias(f"_s{i}"), F.sum(f"_c{i}").alias(f"_c{i}"),
            F.min(F.col(f"_lo{i}").cast("double")).alias(f"_lo{i}"), F.max(F.col(f"_hi{i}").cast("double")).alias(f"_hi{i}"))])
    # sums keep their own type: one column for each that occurs
    types = [halves.schema[f"_s{i}"].dataType for i in parts]
    kinds = list(dict.fromkeys(types))
    long = F.array(*[F.struct(
        F.lit(m).alias("metric"), F.col(f"_c{i}").alias("_c"), F.col(f"_lo{i}").alias("_lo"), F.col(f"_hi{i}").alias("_hi"),
        *[(F.col(f"_s{i}") if t == types[i] else F.lit(None).cast(t)).alias(f"_s{k}") for k, t in enumerate(kinds)])
        for i, m in enumerate(metrics)])
    rows = halves.select(*by, *pcols, "_e", "_ed", "_n", F.inline(long))
    split = {f"{half}{tag}": cond for tag, e in (("", F.col("_e")), ("d", F.col("_ed"))) for half, cond in (("1", e), ("2", ~e))}
    aggs = [F.sum("_n").alias("total_days"), F.sum("_c").alias("days_with_data"),
            F.min("_lo").alias("lo"), F.max("_hi").alias("hi"),
            *[F.sum(f"_s{k}").alias(f"_t{k}") for k in range(len(kinds))]]
    for tag, cond in split.items():
        aggs += [F.coalesce(F.sum(F.when(cond, F.col("_c"))), F.lit(0)).alias(f"c{tag}"),
                 *[F.sum(F.when(cond, F.col(f"_s{k}"))).alias(f"_t{k}_{tag}") for k in range(len(kinds))]]
    got = rows.groupBy(*by, *pcols, "metric").agg(*aggs)
    mean = lambda tag, c: F.coalesce(*[mean_of(F.col(f"_t{k}{tag}"), F.col(c)) for k in range(len(kinds))])
    return got.select(*by, "total_days", "metric", "days_with_data", mean("", "days_with_data").alias("mean"), "lo", "hi",
                      *[x for tag in split for x in (mean(f"_{tag}", f"c{tag}").alias(f"m{tag}"), F.col(f"c{tag}"))])


def _pct(tag: str = "") -> tuple[Column, Column]:
    """(valid, pct) of the split-half change ``(mean2 - mean1) / mean1 * 100``.

    ``valid`` is false when a half is empty or the first mean is zero.
    """
    m1, m2 = F.col(f"m1{tag}"), F.col(f"m2{tag}")
    valid = (F.col(f"c1{tag}") > 0) & (F.col(f"c2{tag}") > 0) & (m1 != 0)
    return valid, F.when(valid, F.try_divide(m2 - m1, m1) * F.lit(100.0))


def summarize(stats: DataFrame, by: Sequence[str] = PERIOD) -> DataFrame:
    """Metric summaries (mean, min, max, split-half trend) from ``metric_stats``.

    A NaN change (a NaN among the values) is ``stable``, as it exceeds no limit.
    """
    pct = F.coalesce(_pct()[1], F.lit(0.0))
    trend = (F.when(F.isnan(pct), F.lit("stable"))
             .when(pct > TREND_THRESHOLD_PCT, F.lit("improving"))
             .when(pct < -TREND_THRESHOLD_PCT, F.lit("declining"))
             .otherwise(F.lit("stable")))
    return (stats.where(F.col("days_with_data") > 0)
            .select(*by, "metric", round2(F.col("mean")).alias("mean"), round2(F.col("lo")).alias("min_val"),
                    round2(F.col("hi")).alias("max_val"), trend.alias("trend_direction"),
                    round2(pct).alias("trend_pct"), "days_with_data", "total_days"))


def metric_summary(df: DataFrame, by: Sequence[str] = PERIOD,
                   metrics: Sequence[str] = WELLNESS_METRICS, day: str = "day",
                   start: Column | str | dt.date = "start_date",
                   end: Column | str | dt.date = "end_date", fixed: Sequence[str] = ()) -> DataFrame:
    """G1 + G2: one row per (by, metric) that has at least one non-null value."""
    return summarize(metric_stats(df, by, metrics, day, start, end, data_split=False, fixed=fixed), by)


def alerts_from_stats(stats: DataFrame, by: Sequence[str] = PERIOD,
                      thresholds: Mapping[str, float] = METRIC_THRESHOLDS,
                      metrics: Sequence[str] = WELLNESS_METRICS,
                      suggestions: Mapping[str, str] = SUGGESTIONS) -> DataFrame:
    """G3 + G4 + G5: threshold alerts win over decline alerts for the same metric.

    Threshold: unrounded mean below the target. Decline: split at the midpoint
    of the first and last day present, change below ``-DECLINE_ALERT_PCT``.
    ``alert_rank`` orders thresholds by table order, then declines by metric order.
    """
    tmap = _lit_map({k: float(v) for k, v in thresholds.items()}, "double")
    t_rank = _lit_map({k: i for i, k in enumerate(thresholds)}, "int")
    d_rank = _lit_map({k: 100 + i for i, k in enumerate(metrics)}, "int")
    target = tmap[F.col("metric")]
    below = target.isNotNull() & (F.col("mean") < target)
    dvalid, dpct = _pct("d")
    declined = dvalid & (dpct < -DECLINE_ALERT_PCT)
    reason = (F.when(below, below_target_reason(target))
              .when(declined, declined_reason(dpct)))
    kind = F.when(below, F.lit("threshold")).when(declined, F.lit("decline"))
    rank = F.when(below, t_rank[F.col("metric")]).otherwise(d_rank[F.col("metric")])
    sugg = F.coalesce(_lit_map(suggestions, "string")[F.col("metric")], F.lit(DEFAULT_SUGGESTION))
    return (stats.where((F.col("days_with_data") > 0) & (below | declined))
            .select(*by, "metric", kind.alias("kind"), reason.alias("reason"),
                    round2(F.col("mean")).alias("current_avg"),
                    sugg.alias("suggestion"), rank.cast("int").alias("alert_rank")))


def threshold_alerts(stats: DataFrame, by: Sequence[str] = PERIOD) -> DataFrame:
    return alerts_from_stats(stats, by).where(F.col("kind") == "threshold")


def decline_alerts(stats: DataFrame, by: Sequence[str] = PERIOD) -> DataFrame:
    """Every decline (also for metrics that also miss their target)."""
    return alerts_from_stats(stats, by, thresholds={}).where(F.col("kind") == "decline")


# ---- personal bests -----------------------------------------------------------

def _best_rows(df: DataFrame, by: Sequence[str], spec: Sequence[tuple[str, str]],
               day: str) -> DataFrame | None:
    spec = [(m, how) for m, how in spec if m in df.columns]
    if not spec:
        return None
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                              F.lit(-1.0 if how == "max" else 1.0).alias("sign"))
                     for m, how in spec])
    return (df.select(*by, F.col(day).alias("day"), F.inline(rows))
            .where(F.col("value").isNotNull()))


def personal_bests(wellness: DataFrame, sleep: DataFrame | None = None,
                   by: Sequence[str] = PERIOD, day: str = "day",
                   wellness_spec: Sequence[tuple[str, str]] = BEST_WELLNESS,
                   sleep_spec: Sequence[tuple[str, str]] = BEST_SLEEP,
                   long_sleep: str = LONG_SLEEP) -> DataFrame:
    """Best value per (by, metric) and the earliest day holding it.

    An aggregate (``min_by`` over (signed value, day)) instead of a window, so
    the work is partially aggregated before the shuffle.
    """
    parts = [_best_rows(wellness, by, wellness_spec, day)]
    if sleep is not None and "sleep_type" in sleep.columns:
        parts.append(_best_rows(sleep.where(F.col("sleep_type") == long_sleep), by, sleep_spec, day))
    parts = [p for p in parts if p is not None]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return earliest_best(u, by)


def earliest_best(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per (by, metric) the row (value, day) with the least ``sign * value``, the earliest day of equal ones."""
    best = rows.groupBy(*by, "metric").agg(
        F.min_by(F.struct("value", "day"), F.struct(F.col("sign") * F.col("value"), F.col("day")))
        .alias("_b"))
    return best.select(*by, "metric", F.col("_b.value").alias("value"), F.col("_b.day").alias("day"))


# ---- sleep, workouts, gate -------------------------------------------------------

# The means and the ratios of the sleep summary, as (output, column, divisor) and (output, part, whole).
SLEEP_MEANS = (("avg_duration_hrs", "total_sleep_duration", 3600), ("avg_efficiency", "efficiency", 1),
               ("avg_hrv", "avg_hrv", 1), ("avg_hr", "avg_hr", 1))
SLEEP_RATIOS = (("deep_pct", "deep_sleep_duration", "total_sleep_duration"),
                ("light_pct", "light_sleep_duration", "total_sleep_duration"),
                ("rem_pct", "rem_sleep_duration", "total_sleep_duration"), ("awake_pct", "awake_time", "time_in_bed"))


def ratio_pct(part: str, whole: str) -> Column:
    """A night's ratio in percent; NULL for a zero denominator."""
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")) * F.lit(100.0)


def sleep_summary(sleep: DataFrame, by: Sequence[str] = PERIOD, long_sleep: str = LONG_SLEEP,
                  fixed: Sequence[str] = ()) -> DataFrame:
    """long_sleep nights only; means of per-night ratios (not ratios of sums).

    A zero denominator gives NULL for that night, which the mean skips.
    """
    ls = sleep.where(F.col("sleep_type") == long_sleep)
    exact = fixed_columns(sleep, fixed)
    return ls.groupBy(*by).agg(
        F.count(F.lit(1)).alias("nights"),
        *[round2(mean_of(F.sum(summable(c, exact)), F.count(c)) / F.lit(by_)).alias(n) for n, c, by_ in SLEEP_MEANS],
        *[round2(F.avg(ratio_pct(a, b))).alias(n) for n, a, b in SLEEP_RATIOS])


def workout_summary(workouts: DataFrame, by: Sequence[str] = PERIOD,
                    activity: str = "workout_activity", calories: str = "workout_calories") -> DataFrame:
    """Sessions per activity (NULL activity is a group) with the period totals.

    Aggregated per activity first; the totals are a window over those few rows.
    """
    per = workouts.groupBy(*by, activity).agg(F.count(F.lit(1)).alias("sessions"),
                                              F.sum(dec(calories)).alias("_cal"))
    return workout_totals(per, by, activity)


def workout_totals(per: DataFrame, by: Sequence[str], activity: str = "workout_activity") -> DataFrame:
    """The workout summary from rows (by, activity, sessions, ``_cal``), one per group and activity."""
    w = Window.partitionBy(*by)
    return per.select(
        *by, F.col(activity).alias("activity"), "sessions",
        F.sum("sessions").over(w).cast("long").alias("total_count"),
        F.coalesce(F.sum("_cal").over(w), F.lit(0).cast(DEC)).cast("double").alias("total_calories"))


def packed_by_activity(summary: DataFrame, by: Sequence[str] = PERIOD) -> DataFrame:
    """one row per group with ``by_activity`` as a map (activity -> sessions).

    The long rows of ``workout_summary`` stay the contract (map order is not
    kept); the map is only a final packing, bounded by the activity vocabulary. A
    map has no NULL key: sessions without an activity and with an empty one share
    the key ``""``.
    """
    named = summary.withColumn("_k", F.coalesce(F.col("activity"), F.lit("")))
    per = named.groupBy(*by, "_k").agg(
        F.sum("sessions").alias("_v"), F.max("total_count").alias("total_count"),
        F.max("total_calories").alias("total_calories"))
    return per.groupBy(*by).agg(
        F.max("total_count").alias("total_count"), F.max("total_calories").alias("total_calories"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("_k").alias("k"), F.col("_v").alias("v")))))
        .alias("by_activity"))


def display_order(df: DataFrame, by: Sequence[str] = PERIOD, name: str = "metric") -> DataFrame:
    """Order a report part for display (by group, then name or day); sink only."""
    return df.orderBy(*by, name)


def sufficiency_gate(wellness: DataFrame, by: Sequence[str] = PERIOD,
                     a: str = "readiness_score", b: str = "sleep_score",
                     min_rows: int = MIN_SCORE_ROWS) -> DataFrame:
    """``skipped`` when both score columns have fewer than ``min_rows`` values."""
    ca = F.count(F.col(a)) if a in wellness.columns else F.lit(0).cast("long")
    cb = F.count(F.col(b)) if b in wellness.columns else F.lit(0).cast("long")
    return _gate(wellness.groupBy(*by).agg(ca.alias("n_a"), cb.alias("n_b")), by, a, b, min_rows)


def gate_from_stats(stats: DataFrame, by: Sequence[str] = PERIOD, a: str = "readiness_score",
                    b: str = "sleep_score", min_rows: int = MIN_SCORE_ROWS) -> DataFrame:
    """The same gate from ``metric_stats``, whose value counts it needs."""
    def n(m: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("metric") == m, F.col("days_with_data"))), F.lit(0)).cast("long")
    return _gate(stats.groupBy(*by).agg(n(a).alias("n_a"), n(b).alias("n_b")), by, a, b, min_rows)


def _gate(counts: DataFrame, by: Sequence[str], a: str, b: str, min_rows: int) -> DataFrame:
    skipped = (F.col("n_a") < min_rows) & (F.col("n_b") < min_rows)
    reason = F.format_string(GATE_REASON.format(min_rows=min_rows, a=a, b=b), F.col("n_a"), F.col("n_b"))
    return counts.select(*by, F.col("n_a").alias(f"n_{a}"), F.col("n_b").alias(f"n_{b}"),
                         F.when(skipped, F.lit("skipped")).otherwise(F.lit("ok")).alias("status"),
                         F.when(skipped, reason).alias("reason"))


def keep_ok(part: DataFrame, gate: DataFrame, by: Sequence[str] = PERIOD) -> DataFrame:
    """Rows of a report part whose group passed the sufficiency gate (left semi join
    of two per-group tables, so no group is larger than its own report rows)."""
    ok = gate.where(F.col("status") == "ok").select(*by)
    return part.join(ok, list(by), "left_semi")


def build_report(wellness: DataFrame, sleep: DataFrame, workouts: DataFrame,
                 by: Sequence[str] = PERIOD, long_sleep: str = LONG_SLEEP,
                 fixed: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All report parts for every group of ``by``; parts of skipped groups are dropped.

    A job runs here: the statistics (a row per group and metric) are computed and
    stored once; gate, summaries and alerts read that table. Only the bests scan
    ``wellness`` besides.
    """
    stats = stored(metric_stats(wellness, by, fixed=fixed), "report-stats")
    gate = gate_from_stats(stats, by)

    def keep(df: DataFrame) -> DataFrame:
        return keep_ok(df, gate, by)

    return {
        "gate": gate,
        "metric_summaries": keep(summarize(stats, by)),
        "personal_bests": keep(personal_bests(wellness, sleep, by, long_sleep=long_sleep)),
        "areas_to_improve": keep(alerts_from_stats(stats, by)),
        "sleep_summary": keep(sleep_summary(sleep, by, long_sleep, fixed)),
        "workout_summary": keep(workout_summary(workouts, by)),
    }


SLEEP_FIELDS = ("nights", "avg_duration_hrs", "avg_efficiency", "avg_hrv", "avg_hr", "deep_pct", "light_pct",
                "rem_pct", "awake_pct")


def report_long(parts: Mapping[str, DataFrame], by: Sequence[str] = PERIOD,
                a: str = "readiness_score", b: str = "sleep_score") -> DataFrame:
    """The whole report as one table: (by, part, item, value, text)."""
    def rows(part: str, item: Column, value: Column, text: Column) -> DataFrame:
        return parts[part].select(*by, F.lit(part).alias("part"), item.alias("item"),
                                  value.cast("double").alias("value"), text.cast("string").alias("text"))

    def unpivoted(part: str, fields: Sequence[tuple[str, str]], text: Column) -> DataFrame:
        items = F.array(*[F.struct(F.lit(n).alias("item"), F.col(c).cast("double").alias("value")) for n, c in fields])
        return parts[part].select(*by, F.lit(part).alias("part"), F.inline(items), text.cast("string").alias("text")) \
            .select(*by, "part", "item", "value", "text")

    none = F.lit(None)
    out = [unpivoted("gate", [(a, f"n_{a}"), (b, f"n_{b}")], F.col("status")),
           rows("metric_summaries", F.col("metric"), F.col("mean"), F.col("trend_direction")),
           rows("personal_bests", F.col("metric"), F.col("value"), F.col("day")),
           rows("areas_to_improve", F.col("metric"), F.col("current_avg"), F.col("reason")),
           unpivoted("sleep_summary", [(f, f) for f in SLEEP_FIELDS], none),
           rows("workout_summary", F.col("activity"), F.col("sessions"), none)]
    whole = out[0]
    for df in out[1:]:
        whole = whole.unionByName(df)
    return whole
