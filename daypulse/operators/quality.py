"""Data-quality operators over landed, staged and mart tables.

All are aggregations with partial (map-side) combine; none collects rows to
the driver. Grids of feeds x days are generated by ``explode`` of a date
sequence (both are calendar- and registry-bounded), not by a cross join.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.display import audit_status
from ..session import path_exists, stored


def not_null_audit(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Q1: per column, NULL count in one pass -> ``(model, column, rows, failures, passed)``."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_f{i}") for i, c in enumerate(columns)]
    g = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_f{i}").alias("failures"))
                     for i, c in enumerate(columns)])
    return g.select(F.lit(model).alias("model"), F.inline(rows), F.col("_rows").alias("rows")) \
        .select("model", "column", "rows", "failures", (F.col("failures") == 0).alias("passed"))


#: What a write says about itself: the load (any name of the caller's), the model, its rows, and per column the non-NULL ones.
METRICS = "load string, model string, `column` string, rows bigint, non_null bigint"


def write_audited(df: DataFrame, path: str, model: str, metrics: str, load: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> int:
    """Write a model and, observed on that write, its row count and non-NULL count of every column; rows written.

    No second scan: the counts ride on the write's own tasks. They go to the small table ``metrics`` (a row a
    column and load), where a load that is written again replaces its earlier counts (``read_metrics``).
    """
    spark, columns = df.sparkSession, df.columns
    rows, counts = 0, [0] * len(columns)
    if df.isEmpty():  # stops at the first row; an empty plan carries no observation
        out = df
    else:
        obs = Observation(f"audit_{uuid.uuid4().hex[:8]}")
        out = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                         *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    w = out.write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    if out is not df:
        got = obs.get
        rows, counts = int(got["rows"]), [int(got[f"c{i}"]) for i in range(len(columns))]
    said = spark.createDataFrame([(load, model, c, rows, n) for c, n in zip(columns, counts)], METRICS)
    said.coalesce(1).withColumn("written", F.current_timestamp()).write.mode("append").parquet(metrics)
    return rows


def read_metrics(spark: SparkSession, metrics: str) -> DataFrame:
    """The counts of every (load, model, column), the last written where one was written again."""
    rows = spark.read.schema(f"{METRICS}, written timestamp").parquet(metrics)
    last = rows.groupBy("load", "model", "column").agg(F.max_by(F.struct("rows", "non_null"), "written").alias("m"))
    return last.select("load", "model", "column", "m.rows", "m.non_null")


def not_null_from_metrics(metrics: DataFrame, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Q1 over all loads of each model from their metrics alone: ``columns`` lists what must not be NULL by model."""
    wanted = [F.struct(F.lit(m).alias("m"), F.lit(c).alias("c")) for m, cs in columns.items() for c in cs]
    total = metrics.where(F.struct(F.col("model").alias("m"), F.col("column").alias("c")).isin(wanted)).groupBy("model", "column").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("rows") - F.col("non_null")).alias("failures"))
    return total.select("model", "column", "rows", "failures", (F.col("failures") == 0).alias("passed"))


def completeness(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``count(*)`` against ``count(col)`` per column (and group)."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.col(c)).alias(f"_n{i}")
                                                 for i, c in enumerate(columns)]
    g = df.groupBy(*by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("non_null"))
                     for i, c in enumerate(columns)])
    return g.select(*by, F.col("_rows").alias("total_rows"), F.inline(rows)) \
        .withColumn("nulls", F.col("total_rows") - F.col("non_null"))


def coverage(df: DataFrame, day: str = "partition_date", by: Sequence[str] = ()) -> DataFrame:
    """First day, last day and number of distinct days (per group)."""
    return df.groupBy(*by).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"),
                               F.count_distinct(F.col(day)).alias("days"),
                               F.count(F.lit(1)).alias("rows"))


def key_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q6: non-NULL and NULL counts of key columns in one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count(F.col(c)).alias(f"{c}_non_null") for c in columns],
                  *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``UNION ALL`` of per-table counts with the table name."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"),
                                                                  "row_count")
             for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def row_count_check(spark: SparkSession, table: str, path: str | None = None) -> DataFrame:
    """Q2: ``WARN`` when the table is missing or empty, else a plain pass; ``passed`` is always true.

    ``path`` reads a Parquet folder; otherwise ``table`` is looked up in the catalog.
    """
    exists = path_exists(spark, path) if path is not None else spark.catalog.tableExists(table)
    if not exists:
        base = spark.range(1).select(F.lit(0).cast("long").alias("row_count"))
    else:
        df = spark.table(table) if path is None else spark.read.parquet(path)
        base = df.agg(F.count(F.lit(1)).alias("row_count"))
    n = F.col("row_count")
    if exists:
        severity = F.when(n == 0, F.lit("WARN"))
        desc = F.when(n == 0, F.lit(f"Table {table} exists but has no rows."))
    else:
        severity, desc = F.lit("WARN"), F.lit(f"Table {table} does not exist yet.")
    return base.select(F.lit(table).alias("table_name"), F.lit(exists).alias("exists"), n,
                       severity.alias("severity"), F.lit(True).alias("passed"),
                       desc.alias("description"))


def trailing_daily_sum(df: DataFrame, ts: str, value: str, anchor: dt.date, days: int = 7,
                       by: Sequence[str] = ()) -> DataFrame:
    """Per day, sum of ``value`` over the ``days`` days before ``anchor``.

    The range predicate is on the raw timestamp so it reaches the scan.
    """
    ts_type = df.schema[ts].dataType
    lo = F.lit(f"{anchor - dt.timedelta(days=days)} 00:00:00").cast(ts_type)
    hi = F.lit(f"{anchor} 00:00:00").cast(ts_type)
    return (df.where((F.col(ts) >= lo) & (F.col(ts) < hi))
            .groupBy(*by, F.to_date(F.col(ts)).alias("day"))
            .agg(F.sum(F.col(value).cast(T.DecimalType(38, 9))).cast("double").alias("total"),
                 F.count(F.lit(1)).alias("rows")))


def day_grid(feeds: DataFrame, start: dt.date | Column, end: dt.date | Column,
             feed: str = "feed") -> DataFrame:
    """Every feed x every day from ``start`` to ``end`` (explode of a date sequence).

    Other columns of ``feeds`` (e.g. a problem / control group label) are kept.
    """
    s = F.lit(start) if isinstance(start, dt.date) else start
    e = F.lit(end) if isinstance(end, dt.date) else end
    return feeds.select("*", F.explode(F.sequence(s, e, F.expr("interval 1 day"))).alias("day"))


def feed_day_grid(counts: DataFrame, feeds: DataFrame, start: dt.date | Column,
                  end: dt.date | Column, feed: str = "feed", day: str = "day",
                  rows: str = "rows", existing: DataFrame | None = None) -> DataFrame:
    """Rows per feed and day on the full grid, with an audit status.

    ``counts`` holds (feed, day, rows); missing cells count 0 (``empty``).
    ``existing`` (one column ``feed``) lists feeds whose table exists; other
    feeds are ``missing``. ``trailing_window`` gives a range from an anchor.
    """
    grid = day_grid(feeds, start, end, feed)
    out = grid.join(counts.select(feed, F.col(day).alias("day"), rows), [feed, "day"], "left") \
        .withColumn(rows, F.coalesce(F.col(rows), F.lit(0)).cast("long"))
    ex = None
    if existing is not None:
        out = out.join(existing.select(feed).withColumn("_exists", F.lit(True)), [feed], "left")
        ex = F.coalesce(F.col("_exists"), F.lit(False))
    out = out.withColumn("status", audit_status(rows, ex))
    return out.drop("_exists") if existing is not None else out


def trailing_window(anchor: dt.date | Column, days: int) -> tuple[Column, Column]:
    """First and last day of the ``days`` days before ``anchor`` (which is not included)."""
    a = F.lit(anchor) if isinstance(anchor, dt.date) else anchor
    return F.date_sub(a, days), F.date_sub(a, 1)


def feed_coverage(grid: DataFrame, feed: str = "feed", rows: str = "rows") -> DataFrame:
    """Q3 summary: rows per feed over the grid, with ``OK but no data`` for empty feeds."""
    g = grid.groupBy(feed).agg(F.sum(rows).cast("long").alias("rows"),
                               F.count_if(F.col(rows) > 0).alias("days_with_rows"))
    return g.withColumn("note", F.when(F.col("rows") == 0, F.lit("OK but no data")).otherwise(F.lit("")))


def reconcile(raw: DataFrame, staged: DataFrame, keys: Sequence[str],
              partition: str = "partition_date", method: str = "count") -> DataFrame:
    """Per partition, rows on each side and how they match on the keys.

    ``method="count"``: both sides are counted per (partition, keys) in one
    aggregation (NULL ids group like any other, hot ids combine map-side); matched
    is the smaller count of the two, missing and extra the rest. ``method="checksum"``: no row-level join -- per partition
    the row count and an order-independent checksum of the keys on each side
    (aggregates only, so only one row per partition is shuffled); run the count
    form afterwards on the partitions whose ``equal`` is false. ``method="tree"``: the rows of
    ``count`` from checksums per partition and hash range of the keys; see ``_reconcile_tree``.
    """
    if method == "tree":
        return _reconcile_tree(raw, staged, keys, partition)
    if method == "checksum":
        def side(df: DataFrame, tag: str) -> DataFrame:
            h = F.xxhash64(*[F.col(k) for k in keys]).cast(T.DecimalType(38, 0))
            return df.groupBy(partition).agg(F.count(F.lit(1)).alias(f"{tag}_rows"),
                                             F.sum(h).alias(f"{tag}_checksum"))
        u = side(raw, "raw").unionByName(side(staged, "staged"), allowMissingColumns=True)
        g = u.groupBy(partition).agg(*[F.max(c).alias(c) for c in
                                       ("raw_rows", "raw_checksum", "staged_rows", "staged_checksum")])
        return g.select(partition, F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"),
                        F.coalesce("staged_rows", F.lit(0)).alias("staged_rows"),
                        ((F.coalesce("raw_rows", F.lit(0)) == F.coalesce("staged_rows", F.lit(0))) &
                         F.col("raw_checksum").eqNullSafe(F.col("staged_checksum"))).alias("equal"))
    if method != "count":
        raise ValueError(f"unknown method {method!r}")
    return _per_partition(_sides(raw, staged, keys, partition).groupBy(partition, *keys).agg(
        F.sum("_r").alias("_r"), F.sum("_s").alias("_s")), partition)


#: Hash ranges that a partition's keys are cut into.
RANGES = 4096


def _reconcile_tree(raw: DataFrame, staged: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """``reconcile`` by descending from partitions to hash ranges to ids, only where checksums differ.

    One pass over both sides sums a checksum per (partition, range) of either (combined map-side: at most
    ``RANGES`` rows a partition and task) and is stored. Ranges with equal counts and checksums are matched as
    they are; a difference in one is missed with a chance of 2^-64. Only partitions with an unequal range are
    read again, and of these only the ids in such ranges are shuffled.
    """
    name = F.xxhash64(*[F.col(k) for k in keys])
    both = _sides(raw, staged, keys, partition)
    sides = both.select(partition, "_r", "_s", F.pmod(name, F.lit(RANGES)).alias("_range"),
                        name.cast(T.DecimalType(38, 0)).alias("_h"))
    leaves = stored(sides.groupBy(partition, "_range").agg(
        F.sum("_r").alias("_r"), F.sum("_s").alias("_s"), F.sum(F.when(F.col("_r") == 1, F.col("_h"))).alias("_hr"),
        F.sum(F.when(F.col("_s") == 1, F.col("_h"))).alias("_hs")), "reconcile-ranges")
    equal = (F.col("_r") == F.col("_s")) & F.col("_hr").eqNullSafe(F.col("_hs"))
    alike = leaves.where(equal).select(partition, "_r", "_s")
    unequal = leaves.where(~equal).select(F.col(partition).alias("_p"), F.col("_range").alias("_q"))
    days = [r["_p"] for r in unequal.select("_p").distinct().collect()]  # bounded by the calendar
    if not days:
        return _per_partition(alike, partition)
    some = F.col(partition).isin([d for d in days if d is not None])
    some = F.coalesce(some, F.lit(None in days))
    cut = lambda df: df.where(some).withColumn("_range", F.pmod(name, F.lit(RANGES)))
    rest = _sides(cut(raw), cut(staged), [*keys, "_range"], partition)
    rest = rest.join(unequal, F.col(partition).eqNullSafe(F.col("_p")) & (F.col("_range") == F.col("_q")), "left_semi")
    per_id = rest.groupBy(partition, *keys).agg(F.sum("_r").alias("_r"), F.sum("_s").alias("_s"))
    return _per_partition(alike.unionByName(per_id.select(partition, "_r", "_s")), partition)


def _sides(raw: DataFrame, staged: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """The keys of both sides with ``_r`` and ``_s``, 1 on the row's own side."""
    r = raw.select(partition, *keys, F.lit(1).cast("long").alias("_r"), F.lit(0).cast("long").alias("_s"))
    s = staged.select(partition, *keys, F.lit(0).cast("long").alias("_r"), F.lit(1).cast("long").alias("_s"))
    return r.unionByName(s)


def _per_partition(counts: DataFrame, partition: str) -> DataFrame:
    """The report from counts ``_r`` and ``_s`` of whatever is compared as one."""
    return counts.groupBy(partition).agg(
        F.sum("_r").alias("raw_rows"), F.sum("_s").alias("staged_rows"),
        F.sum(F.least("_r", "_s")).alias("matched"),
        F.sum(F.greatest(F.col("_r") - F.col("_s"), F.lit(0))).cast("long").alias("missing_in_staged"),
        F.sum(F.greatest(F.col("_s") - F.col("_r"), F.lit(0))).cast("long").alias("extra_in_staged"))
