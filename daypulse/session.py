"""Session helpers: a configured SparkSession and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "daypulse", **conf: str) -> SparkSession:
    """A session with AQE on, the UI off and UTC as the session time zone.

    Master, memory and partition counts belong to the cluster (``spark-submit``,
    its defaults file) or to ``conf``; nothing here overrides them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint folder). A
    ``local`` or ``local[n]`` master is one process on one machine, so there, and
    only there, an unset folder is made once; on a cluster it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="daypulse-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


_MADE: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder; see ``drop_work_folders``."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through Spark's own file system layer (any store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder on its own store; an error if the store refuses."""
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    if not a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b):
        raise OSError(f"cannot rename {source} to {target}")


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(x.getPath().getName() for x in found)


def drop_work_folders(spark: SparkSession) -> int:
    """Delete every folder that ``fresh_path`` gave out in this process; results read from them end."""
    n = len(_MADE)
    while _MADE:
        delete_path(spark, _MADE.pop())
    return n


def stored(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` now, write it once as Parquet to the shared folder and read it back.

    An explicit materialise step: it cuts the lineage, survives lost executors, and what
    reads it gets column pruning and pushed filters. A failed write raises.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
