"""Compaction of streamed loads: a day's many small loads become few files, without a moment of doubt.

    <root>/<feed>/partition_date=D/load_id=K/            what a batch wrote (see ``landing``)
    <root>/<feed>_compacted/gen=G/partition_date=D/      the records of D's loads up to some K, few files
    <root>/<feed>_manifest/version=V/                    (partition_date, gen, upto) for every compacted day

``compact`` writes a new generation beside everything else and then publishes a manifest version, which Spark's
job commit makes complete or not there at all. Readers (``landing.read_streamed``) take the newest complete
version: for a compacted day the named generation and the loads after ``upto``, for other days all loads. So
each record is seen once before, while and after a compaction runs. A batch that is replayed later writes its
folder again, at or below ``upto``, where nobody looks. ``vacuum`` deletes what no reader of the newest version
needs; run it when no reader of an older one is left. One compactor at a time; streams may go on writing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, list_folder, path_exists

MANIFEST = "partition_date date, gen int, upto int"


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    found = (x.removeprefix(prefix) for x in list_folder(spark, path) if x.startswith(prefix))
    return sorted(int(x) for x in found if x.isdigit())


def _versions(spark: SparkSession, root: str, name: str) -> list[int]:
    """Complete manifest versions."""
    path = f"{root}/{name}_manifest"
    return [v for v in _numbered(spark, path, "version=") if path_exists(spark, f"{path}/version={v}/_SUCCESS")]


def manifest(spark: SparkSession, root: str, name: str) -> dict[dt.date, tuple[int, int]]:
    """Day -> (gen, upto) of the newest version; bounded by the calendar."""
    versions = _versions(spark, root, name)
    if not versions:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/{name}_manifest/version={versions[-1]}").collect()
    return {r.partition_date: (r.gen, r.upto) for r in rows}


def loads(spark: SparkSession, root: str, name: str) -> dict[dt.date, list[int]]:
    """Day -> load ids of its folders (a listing, no data is read)."""
    days = [x.removeprefix("partition_date=") for x in list_folder(spark, f"{root}/{name}") if x.startswith("partition_date=")]
    return {dt.date.fromisoformat(d): _numbered(spark, f"{root}/{name}/partition_date={d}", "load_id=") for d in days}


def compact(spark: SparkSession, root: str, name: str, min_loads: int = 2, settled_only: bool = True) -> dict[str, int]:
    """Fold the loads of every day that has at least ``min_loads`` new ones; their files are sized by AQE's advisory size.

    With ``settled_only`` the table's newest load is left out: a stream starts a batch once the one before is
    committed, so all others are complete on any store.
    """
    known, found = manifest(spark, root, name), loads(spark, root, name)
    newest = max((k for ks in found.values() for k in ks), default=-1)
    fold: dict[dt.date, list[int]] = {}
    for day, ks in found.items():
        new = [k for k in ks if k > known.get(day, (0, -1))[1] and not (settled_only and k == newest)]
        if len(new) >= min_loads:
            fold[day] = new
    if not fold:
        return {"days": 0, "loads": 0}
    gen = max([*_numbered(spark, f"{root}/{name}_compacted", "gen="), 0]) + 1
    base = f"{root}/{name}"
    rows = spark.read.option("basePath", base).parquet(
        *[f"{base}/partition_date={d.isoformat()}/load_id={k}" for d, ks in fold.items() for k in ks]).drop("load_id")
    old = [f"{base}_compacted/gen={known[d][0]}/partition_date={d.isoformat()}" for d in fold if d in known]
    if old:
        rows = rows.unionByName(spark.read.option("basePath", f"{base}_compacted").parquet(*old).drop("gen"))
    rows.hint("rebalance", "partition_date").write.partitionBy("partition_date").parquet(f"{base}_compacted/gen={gen}")
    _publish(spark, root, name, known | {d: (gen, max(ks)) for d, ks in fold.items()})
    return {"days": len(fold), "loads": sum(map(len, fold.values()))}


def _publish(spark: SparkSession, root: str, name: str, days: Mapping[dt.date, tuple[int, int]]) -> None:
    path = f"{root}/{name}_manifest"
    version = max([*_numbered(spark, path, "version="), 0]) + 1
    rows = spark.createDataFrame([(d, g, u) for d, (g, u) in sorted(days.items())], MANIFEST)
    rows.coalesce(1).write.parquet(f"{path}/version={version}")


def vacuum(spark: SparkSession, root: str, name: str) -> int:
    """Delete folded loads, generations that the newest manifest does not name, and older manifests; folders deleted."""
    known, n = manifest(spark, root, name), 0
    for day, ks in loads(spark, root, name).items():
        for k in ks:
            if k <= known.get(day, (0, -1))[1]:
                n += delete_path(spark, f"{root}/{name}/partition_date={day.isoformat()}/load_id={k}")
    live = {(g, d) for d, (g, _) in known.items()}
    for g in _numbered(spark, f"{root}/{name}_compacted", "gen="):
        path = f"{root}/{name}_compacted/gen={g}"
        for x in list_folder(spark, path):
            if x.startswith("partition_date=") and (g, dt.date.fromisoformat(x.removeprefix("partition_date="))) not in live:
                n += delete_path(spark, f"{path}/{x}")
        if not any(h == g for h, _ in live):
            n += delete_path(spark, path)
    for v in _versions(spark, root, name)[:-1]:
        n += delete_path(spark, f"{root}/{name}_manifest/version={v}")
    return n


def _of_day(days: Mapping[dt.date, int]) -> Column:
    """A value by ``partition_date`` from a literal map: a filter on partition columns, evaluated while planning."""
    return F.create_map(*[F.lit(x) for kv in sorted(days.items()) for x in kv])[F.col("partition_date")]


def read_compacted(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``raw_data, partition_date`` of all records, each once: the newest manifest's view of the table."""
    known, base, parts = manifest(spark, root, name), f"{root}/{name}", []
    day = F.col("partition_date").cast("date").alias("partition_date")
    if any(loads(spark, root, name).values()):
        rows = spark.read.option("basePath", base).parquet(base)
        if known:
            rows = rows.withColumn("partition_date", day).where(
                F.col("load_id") > F.coalesce(_of_day({d: u for d, (_, u) in known.items()}), F.lit(-1)))
        parts.append(rows.select("raw_data", day))
    if known:
        rows = spark.read.option("basePath", f"{base}_compacted").parquet(f"{base}_compacted").withColumn("partition_date", day)
        parts.append(rows.where(F.col("gen") == _of_day({d: g for d, (g, _) in known.items()})).select("raw_data", day))
    if not parts:
        return spark.read.option("basePath", base).parquet(base).select("raw_data", day)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
