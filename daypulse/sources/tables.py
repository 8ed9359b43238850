"""Stored tables whose parts are replaced safely: whole by a swap, day by day by their partitions."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, list_folder, path_exists, rename_path, stored

_NEXT, _OLD = ".next-", ".old-"


# ---- whole tables -----------------------------------------------------------

def swap_in(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild the table at ``path``: written beside it, then swapped in by two renames.

    A rebuild that fails while it runs leaves the old table as it was (and no rest of its own). ``df`` may
    read the table that it replaces. A process that dies between the renames leaves the old table beside
    the path; the next ``swap_in`` or ``recover`` puts it back. One writer at a time.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    recover(spark, path)
    new, old = f"{path}{_NEXT}{mark}", f"{path}{_OLD}{mark}"
    try:
        w = df.write
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(new)
    except BaseException:
        delete_path(spark, new)
        raise
    there = path_exists(spark, path)
    if there:
        rename_path(spark, path, old)
    try:
        rename_path(spark, new, path)
    except BaseException:
        if there:
            rename_path(spark, old, path)
        raise
    if there:
        delete_path(spark, old)


def recover(spark: SparkSession, path: str) -> bool:
    """After a broken swap: the old table back in its place, leftovers gone. True if a table was put back."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    rests = [x for x in list_folder(spark, parent) if x.startswith((name + _NEXT, name + _OLD))]
    back = False
    for x in sorted(rests):
        if x.startswith(name + _OLD) and not path_exists(spark, path):
            rename_path(spark, f"{parent}/{x}", path)
            back = True
        else:
            delete_path(spark, f"{parent}/{x}")
    return back


# ---- partitions -------------------------------------------------------------

def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> tuple[int, list]:
    """Replace the partitions of ``path`` that occur in ``df``; (rows, their values as tuples of ``by``).

    ``df`` runs once, into the shared folder, from where its partitions take the old ones' place when the job
    commits (dynamic partition overwrite). ``rebalance`` lets AQE size the files by data. For tables of states
    or results; the number of partitions should be bounded by the calendar.
    """
    rows = stored(df, "parts")
    parts = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).collect()
    if parts:
        (rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(path))
    return sum(r["n"] for r in parts), sorted(tuple(r)[:len(by)] for r in parts)


def partition_path(path: str, values: dict) -> str:
    """The folder of one partition (dates and plain names)."""
    return "/".join([path, *(f"{k}={v.isoformat() if isinstance(v, dt.date) else v}" for k, v in values.items())])


def drop_partitions(spark: SparkSession, path: str, by: Sequence[str], values: Sequence[tuple]) -> None:
    for v in values:
        delete_path(spark, partition_path(path, dict(zip(by, v))))
