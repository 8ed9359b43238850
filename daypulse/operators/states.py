"""Reports from mergeable daily states.

Three tables hold what a report needs of a day and nothing else: per (entity, day) the partial statistics
of each wellness metric and of the long-sleep nights, per (entity, day, activity) the workouts. Sums, counts,
least and greatest values merge, so a week or month is rolled up from its days without the rows behind them.

    <root>/state/<wellness | sleep | workouts>/day=YYYY-MM-DD/
    <root>/rollup/<stats | bests | sleep | workouts>/period_type=.../start_date=YYYY-MM-DD/

``update_days`` replaces the states of the days that are new or late and then only the periods that hold one
of them, from the states of those periods' days. Everything else is neither read nor written. Each table is
replaced by partitions (a failed write keeps the old ones) and the same update may be run again; the states go
before the periods, so an update that broke off is finished by repeating it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import dec, fixed_columns, mean_of, round2, summable
from ..session import path_exists
from ..sources.tables import drop_partitions, partition_path, replace_partitions
from . import report

STATES = ("wellness", "sleep", "workouts")
ROLLUPS = ("stats", "bests", "sleep", "workouts")
PERIOD_PARTS = ("period_type", "start_date")


@dataclass(frozen=True)
class Spec:
    """What the states hold. ``fixed`` declares double columns with at most 9 decimals (summed exactly)."""

    keys: tuple[str, ...] = ()
    metrics: tuple[str, ...] = report.WELLNESS_METRICS
    bests: tuple[tuple[str, str], ...] = report.BEST_WELLNESS
    sleep_bests: tuple[tuple[str, str], ...] = report.BEST_SLEEP
    long_sleep: str = report.LONG_SLEEP
    fixed: tuple[str, ...] = ()
    period_types: tuple[str, ...] = ("weekly", "monthly")
    by: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "by", (*self.keys, *report.PERIOD))


# ---- states of days -----------------------------------------------------------

def _signed_least(column: str, how: str) -> Column:
    """The best value so that the least one wins: a greatest value is held negated."""
    return F.min(F.col(column).cast("double") * (-1.0 if how == "max" else 1.0)).alias(f"_b_{column}")


def wellness_state(wellness: DataFrame, spec: Spec) -> DataFrame:
    """Per (keys, day): the row count and the partials of every metric of ``spec`` (absent ones stay NULL)."""
    exact = fixed_columns(wellness, spec.fixed)
    have = set(wellness.columns)
    value = lambda m: summable(m, exact) if m in have else F.lit(None).cast("double")
    rows = wellness.select(*spec.keys, "day", *[value(m).alias(f"_v{i}") for i, m in enumerate(spec.metrics)],
                           *[(F.col(m) if m in have else F.lit(None).cast("double")).alias(m) for m, _ in spec.bests])
    return rows.groupBy(*spec.keys, "day").agg(
        F.count(F.lit(1)).alias("_n"),
        *[x for i in range(len(spec.metrics)) for x in report.partials(F.col(f"_v{i}"), i)],
        *[_signed_least(m, how) for m, how in spec.bests])


def sleep_state(sleep: DataFrame, spec: Spec) -> DataFrame:
    """Per (keys, day): long-sleep nights, sums and counts of the means and ratios, best values."""
    exact = fixed_columns(sleep, spec.fixed)
    nights = sleep.where(F.col("sleep_type") == spec.long_sleep)
    return nights.groupBy(*spec.keys, "day").agg(
        F.count(F.lit(1)).alias("nights"),
        *[x for n, c, _ in report.SLEEP_MEANS for x in (F.sum(summable(c, exact)).alias(f"_s_{n}"), F.count(c).alias(f"_c_{n}"))],
        *[x for n, a, b in report.SLEEP_RATIOS for x in (F.sum(report.ratio_pct(a, b)).alias(f"_s_{n}"),
                                                         F.count(report.ratio_pct(a, b)).alias(f"_c_{n}"))],
        *[_signed_least(m, how) for m, how in spec.sleep_bests])


def workout_state(workouts: DataFrame, spec: Spec, activity: str = "workout_activity",
                  calories: str = "workout_calories") -> DataFrame:
    """Per (keys, day, activity): sessions and calories."""
    return workouts.groupBy(*spec.keys, "day", F.col(activity).alias("activity")).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum(dec(calories)).alias("_cal"))


# ---- periods from states --------------------------------------------------------

def _bests(days: DataFrame, spec: Sequence[tuple[str, str]], by: Sequence[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(-1.0 if how == "max" else 1.0).alias("sign"),
                              F.col(f"_b_{m}").alias("least")) for m, how in spec])
    return (days.select(*by, "day", F.inline(rows)).where("least is not null")
            .select(*by, "day", "metric", "sign", (F.col("least") * F.col("sign")).alias("value")))


def roll_up(states: Mapping[str, DataFrame], spec: Spec) -> dict[str, DataFrame]:
    """The rows of each rollup for every period that the states' days lie in."""
    by = list(spec.by)
    days = {k: report.assign_periods(v, spec.period_types) for k, v in states.items()}
    sleep = days["sleep"].groupBy(*by).agg(
        F.sum("nights").alias("nights"),
        *[round2(mean_of(F.sum(f"_s_{n}"), F.sum(f"_c_{n}")) / F.lit(div)).alias(n) for n, _, div in report.SLEEP_MEANS],
        *[round2(mean_of(F.sum(f"_s_{n}"), F.sum(f"_c_{n}"))).alias(n) for n, _, _ in report.SLEEP_RATIOS])
    best = _bests(days["wellness"], spec.bests, by).unionByName(_bests(days["sleep"], spec.sleep_bests, by))
    per = days["workouts"].groupBy(*by, "activity").agg(F.sum("sessions").alias("sessions"), F.sum("_cal").alias("_cal"))
    return {"stats": report.stats_of_days(days["wellness"], by, spec.metrics),
            "bests": report.earliest_best(best, by),
            "sleep": sleep,
            "workouts": report.workout_totals(per, by, "activity")}


# ---- stored tables --------------------------------------------------------------

def state_path(root: str, name: str) -> str:
    return f"{root}/state/{name}"


def rollup_path(root: str, name: str) -> str:
    return f"{root}/rollup/{name}"


def schema_path(root: str, name: str) -> str:
    """A table without rows that keeps a rollup's schema."""
    return f"{root}/schema/{name}"


def _read_days(spark: SparkSession, path: str, days: Sequence[dt.date], like: DataFrame) -> DataFrame:
    """The states of ``days``: only their folders are listed and read."""
    paths = [p for d in days if path_exists(spark, p := partition_path(path, {"day": d}))]
    if not paths:
        return spark.createDataFrame([], like.schema)
    rows = spark.read.schema(like.schema).option("basePath", path).parquet(*paths)
    return rows.withColumn("day", F.col("day").cast("date")).select(*like.columns)


def period_days(spark: SparkSession, days: Sequence[dt.date], period_types: Sequence[str]) -> tuple[list, list[dt.date]]:
    """The periods that hold one of ``days``, as (period_type, start_date), and all days of these periods."""
    one = spark.createDataFrame([(d,) for d in sorted(set(days))], "day date")
    found = report.assign_periods(one, period_types).select(*report.PERIOD).distinct().collect()  # bounded by the calendar
    every = {r.start_date + dt.timedelta(days=i) for r in found for i in range((r.end_date - r.start_date).days + 1)}
    return sorted((r.period_type, r.start_date) for r in found), sorted(every)


def update_days(spark: SparkSession, root: str, sources: Mapping[str, DataFrame], days: Sequence[dt.date],
                spec: Spec) -> dict[str, int]:
    """Recompute the states of ``days`` (new or late) and the periods that hold them.

    ``sources`` are the wellness mart, the sleep table and the workouts (as ``build_report`` takes them), whole
    or already cut to ``days``; only rows of ``days`` are used. A day or period that has no rows any more goes.
    """
    days = sorted(set(days))
    if not days:
        return {"days": 0, "periods": 0, "days_read": 0}
    make = {"wellness": wellness_state, "sleep": sleep_state, "workouts": workout_state}
    new = {k: make[k](sources[k].where(F.col("day").isin(days)), spec) for k in STATES}
    for k in STATES:
        _, put = replace_partitions(new[k], state_path(root, k), ["day"])
        drop_partitions(spark, state_path(root, k), ["day"], [(d,) for d in days if (d,) not in put])
    periods, every = period_days(spark, days, spec.period_types)
    states = {k: _read_days(spark, state_path(root, k), every, new[k]) for k in STATES}
    # a month's days reach into weeks that no late day is in: these stay
    touched = reduce(lambda a, b: a | b, [(F.col("period_type") == t) & (F.col("start_date") == F.lit(s)) for t, s in periods])
    for k, rows in roll_up(states, spec).items():
        if not path_exists(spark, schema_path(root, k)):
            rows.limit(0).write.mode("overwrite").parquet(schema_path(root, k))
        _, put = replace_partitions(rows.where(touched), rollup_path(root, k), PERIOD_PARTS)
        drop_partitions(spark, rollup_path(root, k), PERIOD_PARTS, [p for p in periods if p not in put])
    return {"days": len(days), "periods": len(periods), "days_read": len(every)}


def read_rollups(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored periods; a rollup that no day has rows for is an empty table."""
    out = {}
    for k in ROLLUPS:
        schema, path = spark.read.parquet(schema_path(root, k)).schema, rollup_path(root, k)
        out[k] = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    return out


def report_from_states(spark: SparkSession, root: str, spec: Spec) -> dict[str, DataFrame]:
    """The parts of ``build_report`` from the stored periods: no row of a source is read."""
    by, r = list(spec.by), read_rollups(spark, root)
    gate = report.gate_from_stats(r["stats"], by)
    keep = lambda df: report.keep_ok(df, gate, by)
    return {"gate": gate, "metric_summaries": keep(report.summarize(r["stats"], by)), "personal_bests": keep(r["bests"]),
            "areas_to_improve": keep(report.alerts_from_stats(r["stats"], by)),
            "sleep_summary": keep(r["sleep"]), "workout_summary": keep(r["workouts"])}
