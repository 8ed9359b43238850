"""Chart series as data: positions, labels and values ready for plotting.

Each series is computed for every group of ``by`` (entity keys plus report
period). Positions come from per-day counts (a window over at most one row per
day) plus a rank inside each (group, day); the rolling mean is a grouped
aggregation over (group, position). No task ever holds a whole series, so an
entity with a third of all rows is spread over its days and positions. The
chart gates are counts over the group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_label
from ..session import stored
from .report import LONG_SLEEP, PERIOD

# Chart lines, the daily step target, bar opacities, the
# rolling window length and the tick density rule.
SCORE_LINES = (("readiness_score", "Readiness"), ("sleep_score", "Sleep"))
STEP_TARGET = 8000
MET_ALPHA, MISSED_ALPHA = 1.0, 0.6
ROLLING_ROWS = 3
TICKS_ALL_UP_TO = 10
TICKS_PER_SERIES = 7
STAGES = (("deep_sleep_duration", "deep"), ("light_sleep_duration", "light"),
          ("rem_sleep_duration", "rem"), ("awake_time", "awake"))


METHODS = ("daily", "window", "range")


def _order(day: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(day), *[F.col(c) for c in tiebreak]]


def positions(df: DataFrame, by: Sequence[str] = PERIOD, day: str = "day",
              tiebreak: Sequence[str] = (), method: str = "daily",
              group_counts: Sequence[str] = ()) -> DataFrame:
    """0-based position ``idx`` and series length ``n`` per group.

    Choose by the rows, not by habit: ``"window"`` for input with a row per day (a mart:
    at most 31 rows per group and month; one scan, one shuffle), ``"range"`` for event
    rows (the series of sleep rows do so by default), ``"daily"`` for event rows where no
    single (group, day) can be hot.

    ``method="daily"`` (default) never puts a whole series in one task: rows
    per (group, day) are counted first (partial aggregation), a window over
    those small per-day counts gives each day's offset and the series length,
    and only the rank inside a day is a window, partitioned by (group, day).
    ``method="window"`` is one row_number over the group. ``method="range"``
    also splits a single hot (group, day) (see ``_positions_by_range``).
    ``group_counts`` adds ``_nn_<col>``: the non-null count of each column over
    the group.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, expected one of {METHODS}")
    grp = Window.partitionBy(*by)
    if method == "range":
        return _positions_by_range(df, by, day, tiebreak, group_counts)
    if method == "window":
        w = Window.partitionBy(*by).orderBy(*_order(day, tiebreak))
        out = (df.withColumn("idx", (F.row_number().over(w) - 1).cast("long"))
               .withColumn("n", F.count(F.lit(1)).over(grp)))
        for c in group_counts:
            out = out.withColumn(f"_nn_{c}", F.count(F.col(c)).over(grp))
        return out
    per_day = df.groupBy(*by, day).agg(F.count(F.lit(1)).alias("_cnt"),
                                        *[F.count(F.col(c)).alias(f"_d_{c}") for c in group_counts])
    before = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.select(
        *[F.col(c).alias(f"_k_{c}") for c in (*by, day)],
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(grp).alias("n"),
        *[F.sum(f"_d_{c}").over(grp).alias(f"_nn_{c}") for c in group_counts])
    cond = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*by, day)]
    j = df.join(per_day, reduce(lambda a, b: a & b, cond), "inner") \
        .drop(*[f"_k_{c}" for c in (*by, day)])
    inner = Window.partitionBy(*by, day).orderBy(*[F.col(c) for c in tiebreak] or [F.lit(1)])
    return (j.withColumn("idx", (F.col("_off") + F.row_number().over(inner) - 1).cast("long"))
            .drop("_off"))


def _null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inner join on ``cols`` where NULL matches NULL (as grouping does)."""
    r = right.select(*[F.col(c).alias(f"_k_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in cols])
    return left.join(r, cond, "inner").drop(*[f"_k_{c}" for c in cols])


def _positions_by_range(df: DataFrame, by: Sequence[str], day: str, tiebreak: Sequence[str],
                        group_counts: Sequence[str]) -> DataFrame:
    """Positions without any window over a (group, day): for days so hot that
    even one entity-day does not fit a task.

    Rows are range-partitioned and sorted by (group, day, tiebreak), numbered
    inside each partition, and written once to the shared folder (a job runs here, so
    that the partition of every row is fixed). A (group, day) spread over several
    partitions becomes segments; offsets come from windows over the segment
    and per-day count tables, which hold one row per segment or per day.
    """
    spark = df.sparkSession
    order = [*by, day, *tiebreak]
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    r = (df.repartitionByRange(n_parts, *[F.col(c) for c in order]).sortWithinPartitions(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id()))
    r = stored(r, "positions")
    seg = r.groupBy(*by, day, "_pid").agg(F.count(F.lit(1)).alias("_sc"), F.min("_mid").alias("_m0"),
                                         *[F.count(F.col(c)).alias(f"_d_{c}") for c in group_counts])
    before_seg = Window.partitionBy(*by, day).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_soff", F.coalesce(F.sum("_sc").over(before_seg), F.lit(0)))
    per_day = seg.groupBy(*by, day).agg(F.sum("_sc").alias("_cnt"),
                                        *[F.sum(f"_d_{c}").alias(f"_d_{c}") for c in group_counts])
    grp = Window.partitionBy(*by)
    before_day = Window.partitionBy(*by).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    per_day = per_day.select(*by, day, F.coalesce(F.sum("_cnt").over(before_day), F.lit(0)).alias("_off"),
                             F.sum("_cnt").over(grp).alias("n"),
                             *[F.sum(f"_d_{c}").over(grp).alias(f"_nn_{c}") for c in group_counts])
    seg = _null_safe_join(seg.select(*by, day, "_pid", "_m0", "_soff"), per_day, [*by, day])
    j = _null_safe_join(r, seg, [*by, day, "_pid"])
    idx = (F.col("_off") + F.col("_soff") + F.col("_mid") - F.col("_m0")).cast("long")
    return j.withColumn("idx", idx).drop("_pid", "_mid", "_m0", "_soff", "_off")


def downsample_nth(df: DataFrame, by: Sequence[str] = PERIOD, day: str = "day",
                   tiebreak: Sequence[str] = (), method: str = "daily") -> DataFrame:
    """All points up to 10; beyond, every ``max(n // 7, 2)``-th point plus the last."""
    p = positions(df, by, day, tiebreak, method)
    step = F.greatest(F.floor(F.col("n") / TICKS_PER_SERIES).cast("long"), F.lit(2).cast("long"))
    keep = ((F.col("n") <= TICKS_ALL_UP_TO) | (F.col("idx") % step == 0)
            | (F.col("idx") == F.col("n") - 1))
    return p.where(keep)


def rolling_mean(df: DataFrame, value: str, by: Sequence[str] = PERIOD, day: str = "day",
                 tiebreak: Sequence[str] = (), rows: int = ROLLING_ROWS) -> Column:
    """W1 as a window: mean of the current and up to ``rows - 1`` preceding rows."""
    w = Window.partitionBy(*by).orderBy(*_order(day, tiebreak)).rowsBetween(-(rows - 1), 0)
    return F.avg(F.col(value)).over(w)


def rolling_by_position(p: DataFrame, value: str, by: Sequence[str], keep: Sequence[str],
                        rows: int = ROLLING_ROWS) -> DataFrame:
    """W1 without a window over the series: each row contributes its value to its own
    position and the next ``rows - 1`` ones, and one grouped aggregation on
    (group, position) averages them (partially aggregated, spread over positions).

    ``p`` has ``idx`` and ``n`` (from ``positions``); ``keep`` columns of the row
    itself are carried through.
    """
    contrib = p.select(*by, *keep, "idx", "n", F.col(value).alias("_v"),
                       F.explode(F.sequence(F.col("idx"), F.col("idx") + rows - 1)).alias("_t"))
    contrib = contrib.where(F.col("_t") < F.col("n"))
    own = F.col("_t") == F.col("idx")
    agg = contrib.groupBy(*by, F.col("_t").alias("idx")).agg(
        F.avg("_v").alias("rolling_mean"),
        F.max(F.when(own, F.col("n"))).alias("n"),
        F.max(F.when(own, F.col("_v"))).alias(value),
        *[F.max(F.when(own, F.col(c))).alias(c) for c in keep])
    return agg


def series_scores(wellness: DataFrame, by: Sequence[str] = PERIOD, day: str = "day",
                  lines: Sequence[tuple[str, str]] = SCORE_LINES,
                  tiebreak: Sequence[str] = (), method: str = "daily") -> DataFrame:
    """One row per (point, line) with a value; NULLs are skipped per line.

    No output for a group with fewer than 2 rows or with every line all NULL.
    """
    cols = [c for c, _ in lines]
    p = positions(wellness.select(*by, day, *cols, *tiebreak), by, day, tiebreak, method, cols)
    anyv = F.greatest(*[F.col(f"_nn_{c}") for c in cols]) if len(cols) > 1 else F.col(f"_nn_{cols[0]}")
    p = p.withColumn("_any", anyv)
    long = p.where((F.col("n") >= 2) & (F.col("_any") > 0)).select(
        *by, day, "idx", day_label(day).alias("label"),
        F.inline(F.array(*[F.struct(F.lit(name).alias("line"), F.col(c).cast("double").alias("value"))
                           for c, name in lines])))
    return long.where(F.col("value").isNotNull())


def series_target(wellness: DataFrame, by: Sequence[str] = PERIOD, day: str = "day",
                  value: str = "steps", target: float = STEP_TARGET,
                  tiebreak: Sequence[str] = (), method: str = "daily") -> DataFrame:
    """Bars with NULL as 0, the target line, and the met flag / opacity.

    No output for a group whose values are all NULL.
    """
    p = positions(wellness.select(*by, day, value, *tiebreak), by, day, tiebreak, method, [value])
    v = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    met = v >= F.lit(float(target))
    return (p.where(F.col(f"_nn_{value}") > 0)
            .select(*by, day, "idx", day_label(day).alias("label"), v.alias("value"),
                    F.lit(float(target)).alias("target"), met.alias("met"),
                    F.when(met, F.lit(MET_ALPHA)).otherwise(F.lit(MISSED_ALPHA)).alias("alpha")))


def series_stacked(sleep: DataFrame, by: Sequence[str] = PERIOD, day: str = "day",
                   tiebreak: Sequence[str] = ("id",), long_sleep: str = LONG_SLEEP,
                   method: str = "range") -> DataFrame:
    """Per long_sleep night the stage hours (NULL -> 0) and their stack bottoms."""
    ls = sleep.where(F.col("sleep_type") == long_sleep)
    p = positions(ls, by, day, tiebreak, method)
    hrs = {name: F.coalesce(F.col(c) / F.lit(3600), F.lit(0.0)) for c, name in STAGES}
    return p.select(
        *by, day, *tiebreak, "idx", day_label(day).alias("label"),
        *[h.alias(f"{k}_h") for k, h in hrs.items()],
        hrs["deep"].alias("light_bottom"),
        (hrs["deep"] + hrs["light"]).alias("rem_bottom"),
        (hrs["deep"] + hrs["light"] + hrs["rem"]).alias("awake_bottom"))


def series_rolling(sleep: DataFrame, by: Sequence[str] = PERIOD, day: str = "day",
                   value: str = "avg_hrv", tiebreak: Sequence[str] = ("id",),
                   long_sleep: str = LONG_SLEEP, method: str = "range") -> DataFrame:
    """C4: non-null long_sleep values and their 3-row mean; needs at least 2 points."""
    ls = sleep.where((F.col("sleep_type") == long_sleep) & F.col(value).isNotNull())
    p = positions(ls.select(*by, day, value, *tiebreak), by, day, tiebreak, method)
    if method == "window":
        out = p.select(*by, day, *tiebreak, "idx", "n", value,
                       rolling_mean(p, value, by, day, tiebreak).alias("rolling_mean"))
    else:
        out = rolling_by_position(p, value, by, keep=(day, *tiebreak))
    return (out.where(F.col("n") >= 2)
            .select(*by, day, *tiebreak, "idx", day_label(day).alias("label"),
                    F.col(value).cast("double").alias("value"), "rolling_mean"))


def chart_series(wellness: DataFrame, sleep: DataFrame, by: Sequence[str] = PERIOD,
                 long_sleep: str = LONG_SLEEP, target: float = STEP_TARGET,
                 wellness_method: str = "window", sleep_method: str = "range") -> dict[str, DataFrame]:
    """All four series, each independent (an empty one does not stop the others).

    ``wellness`` is a mart with a row per day by default (``wellness_method``).
    """
    return {
        "daily_scores": series_scores(wellness, by, method=wellness_method),
        "steps": series_target(wellness, by, target=target, method=wellness_method),
        "sleep_stages": series_stacked(sleep, by, long_sleep=long_sleep, method=sleep_method),
        "hrv_trend": series_rolling(sleep, by, long_sleep=long_sleep, method=sleep_method),
    }


def charts_long(series: dict[str, DataFrame], by: Sequence[str] = PERIOD, day: str = "day") -> DataFrame:
    """The four series as one table: (by, chart, line, day, idx, label, value)."""
    def put(chart: str, lines: Sequence[tuple[Column, Column]]) -> DataFrame:
        rows = F.array(*[F.struct(name.alias("line"), v.cast("double").alias("value")) for name, v in lines])
        return series[chart].select(*by, F.lit(chart).alias("chart"), day, "idx", "label", F.inline(rows)) \
            .select(*by, "chart", "line", day, "idx", "label", "value")

    lit, col = F.lit, F.col
    return reduce(lambda a, b: a.unionByName(b), [
        put("daily_scores", [(col("line"), col("value"))]),
        put("steps", [(lit("steps"), col("value"))]),
        put("sleep_stages", [(lit(k), col(f"{k}_h")) for _, k in STAGES]),
        put("hrv_trend", [(lit("value"), col("value")), (lit("rolling_mean"), F.round("rolling_mean", 6))])])


def chart_counts(series: dict[str, DataFrame], by: Sequence[str] = PERIOD) -> DataFrame:
    """How many of the charts exist per group."""
    parts = [df.select(*by).distinct().withColumn("chart", F.lit(name)) for name, df in series.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy(*by).agg(F.count(F.lit(1)).alias("charts"))


def chart_presence(wellness: DataFrame, sleep: DataFrame, by: Sequence[str] = PERIOD,
                   lines: Sequence[tuple[str, str]] = SCORE_LINES, steps: str = "steps",
                   value: str = "avg_hrv", long_sleep: str = LONG_SLEEP) -> DataFrame:
    """G13 from the gates alone: which of the four charts exist per group, and how many.

    Two grouped aggregations (one per source) are unioned and regrouped, so no
    series is built and no join is needed (NULL keys group like any key).
    """
    cols = [c for c, _ in lines]
    w = wellness.groupBy(*by).agg(
        ((F.count(F.lit(1)) >= 2) & (F.greatest(*[F.count(F.col(c)) for c in cols]) > 0)
         if len(cols) > 1 else (F.count(F.lit(1)) >= 2) & (F.count(F.col(cols[0])) > 0))
        .alias("daily_scores"),
        (F.count(F.col(steps)) > 0).alias("steps"))
    ls = F.col("sleep_type") == long_sleep
    s = sleep.groupBy(*by).agg(
        (F.count_if(ls) > 0).alias("sleep_stages"),
        (F.count_if(ls & F.col(value).isNotNull()) >= 2).alias("hrv_trend"))
    flags = ["daily_scores", "steps", "sleep_stages", "hrv_trend"]
    u = w.unionByName(s, allowMissingColumns=True)
    g = u.groupBy(*by).agg(*[F.coalesce(F.max(f), F.lit(False)).alias(f) for f in flags])
    n = sum((F.col(f).cast("long") for f in flags), F.lit(0).cast("long"))
    return g.withColumn("charts", n).where(F.col("charts") > 0)
