"""The driver's ``events`` table as the feeds of the pipeline.

``events(event_id, ts, user_id, event_type, value, props '{"k": n}')`` is
landed as VARIANT records and staged like any feed; ``user_id`` is the entity
key. Leg roles: click -> readiness, view -> sleep, purchase -> activity,
error -> spo2, signup -> stress, events with ``k >= 50`` -> resilience. The
sleep detail and workout tables are per-event views where ``event_type`` plays
the sleep type / activity (``view`` is the long sleep).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import CENTS
from ..operators.report import assign_periods
from ..operators.stage import project_variant
from ..session import stored
from ..sources.feeds import Column as Spec
from ..sources.feeds import FeedSpec

KEYS = ["user_id"]
BY = ["user_id", "period_type", "start_date", "end_date"]
LONG_SLEEP = "view"

# The staged column map of the events feed.
EVENT_COLUMNS = (
    Spec("id", "bigint", "event_id"),
    Spec("user_id", "bigint", "user_id"),
    Spec("timestamp", "date", "day"),
    Spec("type", "string", "event_type"),
    Spec("value", "double", "value"),
    Spec("props.k", "int", "k"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def land_events(events: DataFrame) -> DataFrame:
    """Events as raw records: ``raw_data VARIANT, partition_date DATE`` (one projection)."""
    rec = F.to_variant_object(F.struct(
        F.col("event_id").alias("id"), F.col("user_id"),
        F.col("ts").cast("string").alias("timestamp"), F.col("event_type").alias("type"),
        F.col("value"), F.try_parse_json(F.col("props")).alias("props")))
    return events.select(rec.alias("raw_data"), F.to_date("ts").alias("partition_date"))


def stage_events(raw: DataFrame, strict: bool = False) -> DataFrame:
    return project_variant(raw, EVENT_COLUMNS, strict=strict)


# The staged columns of the props object.
PROPS_COLUMNS = (Spec("k", "int", "k"),)


def staged_events(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    """Staged events for marts and reports.

    The driver's table is typed except ``props``; by default only ``props`` is staged from
    VARIANT (one parse per row). ``whole`` lands every record as VARIANT and stages all of
    its columns from there, as for a feed.
    """
    e = table(spark, sf_dir, "events")
    if whole:
        return stage_events(land_events(e))
    props = project_variant(e.select("*", F.try_parse_json("props").alias("_p")), PROPS_COLUMNS,
                            variant_col="_p",
                            passthrough=("event_id", "user_id", "ts", "event_type", "value"))
    return props.select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type",
                        "value", "k", F.to_date("ts").alias("partition_date"))


def prepared(events: DataFrame) -> DataFrame:
    """The events with what the records of all feeds are made of: ``_k`` from ``props``, parsed once a row, and ``_day``.

    Inside a record the parse would be repeated for every column (a record's guards are not one common expression).
    """
    if "_k" in events.columns:
        return events
    k = F.try_variant_get(F.try_parse_json(F.col("props")), "$.k", "int")
    return events.withColumn("_k", k).withColumn("_day", F.date_format("ts", "yyyy-MM-dd"))


def feed_records(events: DataFrame, spec: FeedSpec) -> DataFrame:
    """Every event as a record of the feed's shape (``feed_record``): ``raw_data VARIANT, partition_date``."""
    return prepared(events).select(F.to_variant_object(feed_record(spec)).alias("raw_data"),
                                   F.to_date("ts").alias("partition_date"))


def feed_record(spec: FeedSpec) -> Column:
    """A ``prepared`` event as a struct of the feed's shape.

    Column number j (by path, from 1) holds k + j, value + j, type_j or the day, by its
    type; tags are an array, timestamps carry an offset. Where ``k % 10 = j % 10`` the path
    is NULL.
    """
    k, kind, day = F.col("_k"), F.col("event_type"), F.col("_day")
    paths = list(dict.fromkeys(c.path for c in spec.columns))
    tree: dict = {}
    for j, path in enumerate(paths, 1):
        types = {c.type for c in spec.columns if c.path == path}
        if path == "tags":
            v = F.array(kind, F.concat(F.lit("k"), k.cast("string")))
        elif path == "timestamp":
            v = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-07:00"))
        elif "int" in types:
            v = k + j
        elif "double" in types:
            v = F.col("value") + j
        elif "date" in types:
            v = day
        else:
            v = F.concat(kind, F.lit(f"_{j}"))
        node = tree
        *above, leaf = path.split(".")
        for step in above:
            node = node.setdefault(step, {})
        node[leaf] = F.when(k % 10 != j % 10, v)

    def build(node: dict) -> Column:
        return F.struct(*[(build(v) if isinstance(v, dict) else v).alias(n) for n, v in node.items()])

    return build(tree)


def _sum2(cond: Column, value: str = "value") -> Column:
    """Exact sum of 2-decimal values under ``cond`` as DOUBLE."""
    return F.sum(F.when(cond, F.col(value).cast(CENTS))).cast("double")


def event_legs(staged: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """The six daily legs, unique per (user_id, day).

    One aggregation computes every leg. Left alone, column pruning would give
    each leg its own slimmer aggregate and thus its own scan of ``events``; with
    ``materialize`` a job runs here: the per-day aggregate (one row per user and
    day, far smaller than the events) is written once as Parquet to the shared
    folder, and every leg scans its own columns of it with its filter pushed.
    """
    t = F.col("event_type")
    click, view, buy, err, sign = (t == "click", t == "view", t == "purchase", t == "error",
                                   t == "signup")
    res = F.col("k") >= 50
    daily = staged.groupBy("user_id", "day").agg(
        F.count_if(click).alias("n_ready"), _sum2(click).alias("readiness_score"),
        F.count_if(view).alias("n_sleep"), _sum2(view).alias("sleep_score"),
        F.max(F.when(view, F.col("k"))).alias("sleep_efficiency"),
        F.count_if(buy).alias("n_act"), F.count_if(buy).alias("steps"),
        _sum2(buy).alias("calories"),
        F.count_if(err).alias("n_spo2"), F.max(F.when(err, F.col("value"))).alias("avg_spo2_pct"),
        F.min(F.when(err, F.col("value"))).alias("breathing_disturbance_index"),
        F.count_if(sign).alias("n_stress"), _sum2(sign).alias("stress_high"),
        F.count_if(sign).alias("recovery_high"),
        F.max(F.when(sign, F.col("k"))).cast("string").alias("stress_summary"),
        F.count_if(res).alias("n_res"), F.max(F.when(res, t)).alias("resilience_level"),
        _sum2(res).alias("sleep_recovery_score"),
        F.max(F.when(res, F.col("value"))).alias("daytime_recovery_score"),
        F.min(F.when(res, F.col("value"))).alias("resilience_stress_score"),
    )
    if materialize:
        daily = stored(daily, "daily-legs")
    spec = {
        "ready": ("n_ready", ["readiness_score"]),
        "sleep": ("n_sleep", ["sleep_score", "sleep_efficiency"]),
        "act": ("n_act", ["steps", "calories"]),
        "spo2": ("n_spo2", ["avg_spo2_pct", "breathing_disturbance_index"]),
        "stress": ("n_stress", ["stress_high", "recovery_high", "stress_summary"]),
        "res": ("n_res", ["resilience_level", "sleep_recovery_score", "daytime_recovery_score",
                          "resilience_stress_score"]),
    }
    return {leg: daily.where(F.col(n) > 0).select("user_id", "day", *cols)
            for leg, (n, cols) in spec.items()}


def sleep_periods(staged: DataFrame) -> DataFrame:
    """Per-event sleep periods (``event_type`` is the sleep type)."""
    k, v = F.col("k"), F.col("value")
    total = F.round(v * 100).cast("long")
    return staged.select(
        "user_id", F.col("event_id").alias("id"), "day", F.col("event_type").alias("sleep_type"),
        total.alias("total_sleep_duration"), (k * 30).cast("long").alias("deep_sleep_duration"),
        (k * 60).cast("long").alias("light_sleep_duration"),
        ((99 - k) * 30).cast("long").alias("rem_sleep_duration"),
        (k * 5).cast("long").alias("awake_time"), (total + k * 5).alias("time_in_bed"),
        k.alias("efficiency"), v.alias("avg_hr"), v.alias("avg_hrv"), k.alias("lowest_hr"))


def sleep_time(staged: DataFrame) -> DataFrame:
    """Per-day recommendations from signup events (0..n per user and day)."""
    k = F.col("k")
    return staged.where(F.col("event_type") == "signup").select(
        "user_id", "day",
        F.when(k >= 50, F.lit("earlier_bedtime")).otherwise(F.lit("follow_optimal_bedtime"))
        .alias("sleep_recommendation"),
        (-k * 60).cast("int").alias("optimal_bedtime_start_offset"),
        (k * 60).cast("int").alias("optimal_bedtime_end_offset"))


def workouts(staged: DataFrame) -> DataFrame:
    """Per-event workouts (``event_type`` is the activity, ``value`` the calories)."""
    return staged.select("user_id", F.col("event_id").alias("id"), "day",
                         F.col("event_type").alias("workout_activity"),
                         F.col("value").alias("workout_calories"))


def last_day(spark: SparkSession, sf_dir: str) -> dt.date:
    """The last day of the table (one value, from one aggregate)."""
    return table(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).first()[0]


def with_periods(df: DataFrame) -> DataFrame:
    return assign_periods(df, ("weekly", "monthly"))
