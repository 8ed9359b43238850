"""Feed registry: which feeds exist, how each is staged, and its date rule.

A feed is one JSON collection (a daily summary kind or a granular event kind).
The registry is an immutable mapping ``name -> FeedSpec``; ``registry_frame``
exposes it as a small DataFrame for audits.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    path: str          # JSON path below the record root, dot separated
    type: str          # Spark SQL type name used for the cast
    alias: str         # staged column name


@dataclass(frozen=True)
class FeedSpec:
    name: str                          # raw / staged table stem
    endpoint: str                      # collection name at the source
    kind: str                          # "daily" or "granular"
    columns: tuple[Column, ...]
    not_null: tuple[str, ...] = field(default=())
    end_exclusive: bool = False        # source treats the range end as exclusive

    @property
    def staged_name(self) -> str:
        return f"stg_{self.name}"


def _cols(*triples: tuple[str, str, str]) -> tuple[Column, ...]:
    return tuple(Column(p, t, a) for p, t, a in triples)


# ---------------------------------------------------------------------------
# They must equal the source contract for right results.
# Daily kinds and their collection names.
DAILY_ENDPOINTS = {
    "sleep": "daily_sleep",
    "activity": "daily_activity",
    "readiness": "daily_readiness",
    "spo2": "daily_spo2",
    "stress": "daily_stress",
    "resilience": "daily_resilience",
}
# Collections that treat the end of a date range as exclusive.
END_EXCLUSIVE_ENDPOINTS = frozenset({
    "daily_activity", "daily_resilience", "sleep", "workout", "session", "tag",
    "rest_mode_period",
})
# First partition day of the landing schedule.
FIRST_PARTITION_DAY = dt.date(2026, 1, 1)

# Staged column maps: (JSON path, type, staged column) per feed, and the
# columns that must never be NULL after staging.
_SPECS = (
    ("sleep", "daily_sleep", "daily", _cols(
        ("id", "string", "id"),
        ("day", "date", "day"),
        ("score", "int", "sleep_score"),
        ("contributors.deep_sleep", "int", "deep_sleep_score"),
        ("contributors.efficiency", "int", "efficiency_score"),
        ("contributors.latency", "int", "latency_score"),
        ("contributors.rem_sleep", "int", "rem_sleep_score"),
        ("contributors.restfulness", "int", "restfulness_score"),
        ("contributors.timing", "int", "timing_score"),
        ("contributors.total_sleep", "int", "total_sleep_score"),
        ("timestamp", "string", "timestamp"),
    ), ("id", "day", "partition_date", "sleep_score")),
    ("activity", "daily_activity", "daily", _cols(
        ("day", "date", "day"),
        ("steps", "int", "steps"),
        ("total_calories", "int", "calories"),
    ), ("day", "partition_date", "steps")),
    ("readiness", "daily_readiness", "daily", _cols(
        ("day", "date", "day"),
        ("score", "int", "readiness_score"),
    ), ("day", "partition_date", "readiness_score")),
    ("heartrate", "heartrate", "granular", _cols(
        ("timestamp", "string", "ts"),
        ("bpm", "int", "bpm"),
        ("timestamp", "date", "day"),
    ), ("ts", "bpm", "partition_date")),
    ("spo2", "daily_spo2", "daily", _cols(
        ("day", "date", "day"),
        ("spo2_percentage.average", "double", "avg_spo2_pct"),
        ("breathing_disturbance_index", "double", "breathing_disturbance_index"),
    ), ("day", "partition_date", "avg_spo2_pct")),
    ("stress", "daily_stress", "daily", _cols(
        ("day", "date", "day"),
        ("stress_high", "int", "stress_high"),
        ("recovery_high", "int", "recovery_high"),
        ("day_summary", "string", "stress_summary"),
    ), ("day", "partition_date", "stress_high")),
    ("resilience", "daily_resilience", "daily", _cols(
        ("day", "date", "day"),
        ("level", "string", "resilience_level"),
        ("contributors.sleep_recovery", "double", "sleep_recovery_score"),
        ("contributors.daytime_recovery", "double", "daytime_recovery_score"),
        ("contributors.stress", "double", "stress_score"),
    ), ("day", "partition_date", "resilience_level")),
    ("sleep_periods", "sleep", "granular", _cols(
        ("id", "string", "id"),
        ("day", "date", "day"),
        ("bedtime_start", "string", "bedtime_start"),
        ("bedtime_end", "string", "bedtime_end"),
        ("type", "string", "sleep_type"),
        ("total_sleep_duration", "int", "total_sleep_duration"),
        ("deep_sleep_duration", "int", "deep_sleep_duration"),
        ("light_sleep_duration", "int", "light_sleep_duration"),
        ("rem_sleep_duration", "int", "rem_sleep_duration"),
        ("awake_time", "int", "awake_time"),
        ("time_in_bed", "int", "time_in_bed"),
        ("efficiency", "int", "efficiency"),
        ("latency", "int", "latency"),
        ("average_heart_rate", "double", "avg_hr"),
        ("average_hrv", "double", "avg_hrv"),
        ("lowest_heart_rate", "int", "lowest_hr"),
        ("average_breath", "double", "avg_breath"),
        ("restless_periods", "int", "restless_periods"),
    ), ("id", "day", "partition_date", "sleep_type")),
    ("sleep_time", "sleep_time", "granular", _cols(
        ("day", "date", "day"),
        ("optimal_bedtime.start_offset", "int", "optimal_bedtime_start_offset"),
        ("optimal_bedtime.end_offset", "int", "optimal_bedtime_end_offset"),
        ("optimal_bedtime.day_tz", "int", "optimal_bedtime_tz_offset"),
        ("recommendation", "string", "sleep_recommendation"),
        ("status", "string", "sleep_time_status"),
    ), ("day", "partition_date")),
    ("workouts", "workout", "granular", _cols(
        ("id", "string", "id"),
        ("day", "date", "day"),
        ("activity", "string", "workout_activity"),
        ("start_datetime", "string", "start_datetime"),
        ("end_datetime", "string", "end_datetime"),
        ("intensity", "string", "intensity"),
        ("source", "string", "workout_source"),
        ("calories", "double", "workout_calories"),
        ("distance", "double", "workout_distance_m"),
        ("label", "string", "workout_label"),
    ), ("id", "day", "partition_date", "workout_activity")),
    ("sessions", "session", "granular", _cols(
        ("id", "string", "id"),
        ("day", "date", "day"),
        ("start_datetime", "string", "start_datetime"),
        ("end_datetime", "string", "end_datetime"),
        ("type", "string", "session_type"),
        ("mood", "string", "mood"),
    ), ("id", "day", "partition_date")),
    ("tags", "tag", "granular", _cols(
        ("id", "string", "id"),
        ("day", "date", "day"),
        ("timestamp", "string", "tagged_at"),
        ("text", "string", "note_text"),
        ("tags", "string", "tags"),
    ), ("id", "day", "partition_date")),
    ("rest_mode_periods", "rest_mode_period", "granular", _cols(
        ("id", "string", "id"),
        ("start_day", "date", "start_day"),
        ("start_time", "string", "start_time"),
        ("end_day", "date", "end_day"),
        ("end_time", "string", "end_time"),
    ), ("id", "partition_date")),
)
# ---------------------------------------------------------------------------

FEEDS: dict[str, FeedSpec] = {
    name: FeedSpec(name, endpoint, kind, cols, nn, endpoint in END_EXCLUSIVE_ENDPOINTS)
    for name, endpoint, kind, cols, nn in _SPECS
}
VALID_TABLES = frozenset(FEEDS)


def feed(name: str, registry: dict[str, FeedSpec] | None = None) -> FeedSpec:
    """Registry lookup; unknown names are rejected (table whitelist)."""
    reg = FEEDS if registry is None else registry
    if not isinstance(name, str) or name not in reg:
        raise ValueError(f"Invalid table name: {name!r}")
    return reg[name]


def endpoint_for(kind: str) -> str:
    """Daily kind -> collection name; any other name passes through unchanged."""
    return DAILY_ENDPOINTS.get(kind, kind)


def request_end(endpoint: str, end: dt.date) -> dt.date:
    """End date to send for an inclusive ``end``: +1 day where the source is exclusive."""
    return end + dt.timedelta(days=1) if endpoint in END_EXCLUSIVE_ENDPOINTS else end


def day_range(df: DataFrame, ts: str, endpoint: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows of the inclusive days ``start`` .. ``end`` as the source serves them for the request:
    half-open on the raw timestamp (``start <= ts < end + 1 day``), so it is pushed to the scan.

    A source with an exclusive end gets ``request_end`` and cuts there itself; an inclusive
    one covers its last day to midnight. Both give the same rows.
    """
    until = request_end(endpoint, end)
    if endpoint not in END_EXCLUSIVE_ENDPOINTS:
        until += dt.timedelta(days=1)
    kind = df.schema[ts].dataType
    lo, hi = (F.lit(f"{d} 00:00:00").cast(kind) for d in (start, until))
    return df.where((F.col(ts) >= lo) & (F.col(ts) < hi))


def registry_frame(spark: SparkSession) -> DataFrame:
    """The registry as a DataFrame: one row per feed (bounded by the registry size)."""
    schema = T.StructType([
        T.StructField("feed", T.StringType(), False),
        T.StructField("endpoint", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("end_exclusive", T.BooleanType(), False),
        T.StructField("n_columns", T.IntegerType(), False),
    ])
    rows = [(f.name, f.endpoint, f.kind, f.end_exclusive, len(f.columns)) for f in FEEDS.values()]
    return spark.createDataFrame(rows, schema)


def not_null_pairs() -> list[tuple[str, str]]:
    """All (staged model, column) pairs that carry a not-null test."""
    return [(f.staged_name, c) for f in FEEDS.values() for c in f.not_null]
