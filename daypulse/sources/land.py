"""Landing: JSON feeds into day-partitioned VARIANT tables, idempotently.

A raw table is a Parquet folder ``<root>/<feed>/partition_date=YYYY-MM-DD/``
with one column ``raw_data VARIANT``. Loading a day replaces that day only;
re-running a load gives the same table. Everything runs as Spark jobs; the
driver only sees row counts and the (calendar-bounded) list of days written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, path_exists, stored
from .feeds import FeedSpec, feed
from .tables import drop_partitions, replace_partitions, swap_in

RAW_SCHEMA = T.StructType([T.StructField("raw_data", T.VariantType(), True)])


# ---- scans ---------------------------------------------------------------

def _parsed(text: Column, source: Column) -> Column:
    """JSON text as VARIANT; a text that does not parse fails the job and names its file."""
    v = _one_document(text)
    return F.when(v.isNotNull(), v).otherwise(
        F.raise_error(F.concat(F.lit("not valid JSON in "), source)).cast("variant"))


def _one_document(text: Column) -> Column:
    """The text as VARIANT if it is exactly one JSON document, else NULL.

    The parser stops after a first document and says nothing about what follows;
    between brackets anything that follows is an error.
    """
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(items) == 1, F.try_element_at(items, F.lit(1)))


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line -> ``raw_data VARIANT`` (plus any partition columns).

    Empty lines are skipped; a malformed line fails the read, so a load that would
    lose records leaves the table as it was.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    rest = [c for c in lines.columns if c != "value"]
    return lines.select(_parsed(F.col("value"), F.input_file_name()).alias("raw_data"), *rest)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Envelope pages -> ``raw_data VARIANT``: a file is one page over any number of lines, or one page a line.

    Files are read whole (a page is one response of a feed). A file that is neither
    fails the read.
    """
    files = spark.read.text(path, wholetext=True).where(F.trim("value") != "")
    whole = _one_document(F.col("value"))
    texts = F.when(whole.isNotNull(), F.array("value")).otherwise(
        F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != ""))
    rest = [c for c in files.columns if c != "value"]
    pages = files.select(*rest, F.input_file_name().alias("_file"), F.explode(texts).alias("_page"))
    return pages.select(_parsed(F.col("_page"), F.col("_file")).alias("raw_data"), *rest)


def envelope_records(pages: DataFrame, page_col: str = "raw_data",
                     keep: Sequence[str] = ()) -> DataFrame:
    """Records of the ``data`` array of each envelope page, with their position.

    A page without ``data`` (or with a non-array ``data``) yields zero rows.
    """
    arr = F.try_variant_get(F.col(page_col), "$.data", "array<variant>")
    return pages.select(*keep, F.posexplode(arr).alias("pos", "raw_data"))


def to_raw(df: DataFrame, json_col: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Rows -> ``raw_data VARIANT`` in one projection.

    With ``json_col`` the column holds JSON text (parsed leniently: bad text is
    NULL); otherwise all columns other than ``keep`` become one object.
    """
    if json_col is not None:
        v = F.try_parse_json(F.col(json_col))
    else:
        v = F.to_variant_object(F.struct(*[F.col(c) for c in df.columns if c not in keep]))
    return df.select(*keep, v.alias("raw_data"))


def read_raw(spark: SparkSession, root: str, name: str,
             registry: dict[str, FeedSpec] | None = None) -> DataFrame:
    """A landed raw table: ``raw_data VARIANT, partition_date DATE``."""
    feed(name, registry)
    return (spark.read.option("basePath", f"{root}/{name}")
            .parquet(f"{root}/{name}")
            .withColumn("partition_date", F.col("partition_date").cast("date")))


# ---- writes ---------------------------------------------------------------

def _raw_col(batch: DataFrame) -> Column:
    """``raw_data`` as VARIANT: JSON text is parsed (leniently) in the same projection."""
    if isinstance(batch.schema["raw_data"].dataType, T.StringType):
        return F.try_parse_json(F.col("raw_data")).alias("raw_data")
    return F.col("raw_data")


def _check_day(day: dt.date) -> dt.date:
    if isinstance(day, dt.datetime) or not isinstance(day, dt.date):
        raise ValueError(f"partition day must be a date, got {day!r}")
    return day


def upsert_day(spark: SparkSession, root: str, name: str, batch: DataFrame | None,
               day: dt.date, registry: dict[str, FeedSpec] | None = None) -> int:
    """Replace one day of a raw table with ``batch`` and return its row count.

    The new day is written to a staging folder and takes the old one's place when
    the job commits (dynamic partition overwrite), so a load that fails keeps the
    old day. Only a batch that was read to its end without rows (or ``None``) clears
    the day. The count is observed on the write itself.
    """
    feed(name, registry)
    _check_day(day)
    if batch is None:
        _clear(spark, root, name, [day])
        return 0
    dated = batch.select(_raw_col(batch), F.lit(day).alias("partition_date"))
    rows, _ = _overwrite(dated, root, name)
    if rows == 0:
        _clear(spark, root, name, [day])
    return rows


def _overwrite(dated: DataFrame, root: str, name: str) -> tuple[int, set]:
    """Replace the days that occur in ``dated``; (rows, days written).

    ``rebalance`` lets AQE size the files by data: small days are merged into few
    tasks and a hot day is split, whatever the number of input tasks.
    """
    if dated.isEmpty():  # stops at the first row; an empty plan carries no observation
        return 0, set()
    obs = Observation(f"land_{name}")
    out = dated.observe(obs, F.count(F.lit(1)).alias("rows"),
                        F.array_sort(F.collect_set("partition_date")).alias("written"))
    (out.hint("rebalance", "partition_date").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("partition_date").parquet(f"{root}/{name}"))
    m = obs.get
    return int(m["rows"]), set(m["written"] or [])


def _clear(spark: SparkSession, root: str, name: str, days: Sequence[dt.date]) -> None:
    """Empty days by removing their folders (metadata only, no Spark job for each)."""
    empty = spark.createDataFrame([], RAW_SCHEMA).coalesce(1)
    for day in days:
        delete_path(spark, f"{root}/{name}/partition_date={day.isoformat()}")
    if days:  # the table exists from now on, with its schema
        empty.write.mode("overwrite").parquet(f"{root}/{name}/partition_date={days[0].isoformat()}")


def backfill(spark: SparkSession, root: str, name: str, batch: DataFrame,
             days: Iterable[dt.date], registry: dict[str, FeedSpec] | None = None) -> dict[str, int]:
    """Load many days in one job; requested days that got no rows are cleared.

    ``batch`` holds ``raw_data`` and ``partition_date``. Days present in the
    batch are replaced through a dynamic partition overwrite (only touched
    partitions change); requested days absent from the batch are then emptied.
    No requested day: nothing is written.
    Returns ``{"rows": n, "days_written": k, "days_cleared": m}``.
    """
    feed(name, registry)
    days = sorted({_check_day(d) for d in days})
    if not days:
        return {"rows": 0, "days_written": 0, "days_cleared": 0}
    dated = batch.select(_raw_col(batch), F.col("partition_date").cast("date").alias("partition_date"))
    rows, written = _overwrite(dated.where(F.col("partition_date").isin(days)), root, name)
    empty = [d for d in days if d not in written]
    _clear(spark, root, name, empty)
    return {"rows": rows, "days_written": len(written), "days_cleared": len(empty)}


def load_feed_day(spark: SparkSession, root: str, name: str, path: str, day: dt.date,
                  envelope: bool = True, registry: dict[str, FeedSpec] | None = None,
                  max_rejects: int | float | None = None) -> int:
    """A daily or granular feed for one day: read its JSON files and replace the day; rows landed.

    With ``envelope`` the files hold pages ``{"data": [...]}`` and only the records
    of ``data`` are kept (a page without ``data`` adds nothing). A page or line
    that does not parse fails the load and leaves the day as it was.

    With ``max_rejects`` such pages, lines and records that are no object go to the feed's reject table
    (``read_rejected``) instead, with file and reason, and the load goes on: unless there are more than
    that many (an int) or more than that share of all units (a float). Then it fails, the day stays as it
    was and the reject table shows why.
    """
    if max_rejects is None:
        batch = envelope_records(read_pages(spark, path)) if envelope else read_json_records(spark, path)
        return upsert_day(spark, root, name, batch.select("raw_data"), day, registry)
    feed(name, registry)
    _check_day(day)
    read = stored(read_sorted_out(spark, path, envelope), "sorted-out")  # the files are read and parsed once
    bad = F.col("reason").isNotNull()
    rows, rejects = read.agg(F.count_if(~bad), F.count_if(bad)).first()
    rejected = read.where(bad).select("file", "reason", "text", F.lit(day).alias("partition_date"))
    _, put = replace_partitions(rejected, f"{root}/{name}_rejected", ["partition_date"])
    if not put:
        drop_partitions(spark, f"{root}/{name}_rejected", ["partition_date"], [(day,)])
    limit = max_rejects * (rows + rejects) if isinstance(max_rejects, float) else max_rejects
    if rejects > limit:
        raise ValueError(f"{name} {day}: {rejects} of {rows + rejects} units rejected, at most {max_rejects} allowed")
    return upsert_day(spark, root, name, read.where(~bad).select("raw_data"), day, registry)


NOT_JSON, NOT_OBJECT = "not one JSON document", "not an object"


def read_sorted_out(spark: SparkSession, path: str, envelope: bool = True) -> DataFrame:
    """Records and rejected units of JSON files in one pass: ``raw_data, file, reason, text``.

    A unit is a line or, with ``envelope``, a page or a record of its ``data``. ``reason`` is NULL for good
    records; ``text`` is what was rejected.
    """
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    if envelope:
        files = spark.read.text(path, wholetext=True).where(F.trim("value") != "")
        whole = _one_document(F.col("value"))
        texts = F.when(whole.isNotNull(), F.array("value")).otherwise(
            F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != ""))
        units = files.select(F.input_file_name().alias("file"), F.explode(texts).alias("text"))
    else:
        units = spark.read.text(path).where(F.trim("value") != "").select(
            F.input_file_name().alias("file"), F.col("value").alias("text"))
    units = units.withColumn("v", _one_document(F.col("text")))
    bad = F.when(F.col("v").isNull(), F.lit(NOT_JSON)).when(~is_object(F.col("v")), F.lit(NOT_OBJECT))
    units = units.withColumn("reason", bad)
    if envelope:
        found = F.when(F.col("reason").isNull(), F.try_variant_get("v", "$.data", "array<variant>")).otherwise(F.array("v"))
        units = units.select("file", "text", "reason", F.explode(found).alias("v"))
        late = F.coalesce(F.col("reason"), F.when(F.col("v").isNull() | ~is_object(F.col("v")), F.lit(NOT_OBJECT)))
        units = units.select("file", F.when(F.col("reason").isNotNull(), F.col("text")).otherwise(F.to_json("v")).alias("text"),
                             "v", late.alias("reason"))
    return units.select(F.when(F.col("reason").isNull(), F.col("v")).alias("raw_data"), "file", "reason",
                        F.when(F.col("reason").isNotNull(), F.col("text")).alias("text"))


def read_rejected(spark: SparkSession, root: str, name: str) -> DataFrame:
    """What loads of the feed rejected: ``file, reason, text, partition_date``; empty if nothing was."""
    path, schema = f"{root}/{name}_rejected", "file string, reason string, text string, partition_date date"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Full rebuild of a model as a Parquet table; returns a reader on it.

    The new model is written beside the old one and swapped in, so a rebuild that fails keeps the old
    model (``tables.swap_in``). Reading back the written table also cuts the lineage of long plans.
    """
    swap_in(df, path, partition_by)
    return df.sparkSession.read.parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Append-only log write (A13): records are never rewritten; read with ``latest_by``."""
    df.write.mode("append").parquet(path)


# ---- readers on landed / modelled tables ------------------------------------

def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row per ``keys`` by ``order`` (descending, lexicographic).

    An aggregate (``max_by``) rather than a window: partial aggregation runs
    before the shuffle, so a key holding most rows costs no more than others.
    ``order`` should be a total order (add an id) for deterministic ties.
    """
    cols = [c for c in df.columns if c not in keys]
    ordkey = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ordkey).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in cols])


def slice_period(df: DataFrame, start: dt.date | Column, end: dt.date | Column,
                 day_col: str = "day") -> DataFrame:
    """Rows with ``start <= day <= end`` (inclusive; pushed down to the scan)."""
    s = F.lit(start) if isinstance(start, dt.date) else start
    e = F.lit(end) if isinstance(end, dt.date) else end
    return df.where(F.col(day_col).between(s, e))


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def upper_columns(df: DataFrame) -> DataFrame:
    """Names as the warehouse spells unquoted identifiers."""
    return df.toDF(*[c.upper() for c in df.columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header and a declared schema (dates parsed as ``yyyy-MM-dd``)."""
    return spark.read.csv(path, header=True, schema=schema, dateFormat="yyyy-MM-dd")
