"""Small Spark helpers shared by the corpus operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.session import stored

#: Fixed width of a sieve: 2^24 bits = 2 MB, whatever the input's size.
SIEVE_BITS = 24


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def narrow_batches(spark: SparkSession, rows: int = 2000) -> SparkSession:
    """Fewer rows an Arrow batch than Spark's default of 10,000, unless the session has chosen its own.

    Texts are wide: a default batch of them holds tens of MB, twice in the JVM and once in Python.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(rows))
    return spark


def sieve(df: DataFrame, column: str, bits: int = SIEVE_BITS):
    """A broadcast bitmap over the low bits of a long column.

    It has a fixed size, so it may be broadcast at any scale; a value that is in
    ``df`` always passes, others mostly do not (the fuller the bitmap, the more pass).
    It only thins rows before an exact join. Use :func:`passes` on the executors.
    """
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    word = F.shiftrightunsigned(low, 6)
    bit = F.expr(f"shiftleft(1L, cast({column} & 63 as int))")
    got = (df.select(word.alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    table = np.zeros(1 << (bits - 6), np.uint64)
    if got.num_rows:
        table[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    return df.sparkSession.sparkContext.broadcast(table)


def passes(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    v = values.astype(np.int64, copy=False).view(np.uint64) & np.uint64(len(table) * 64 - 1)
    return (table[v >> np.uint64(6)] >> (v & np.uint64(63))) & np.uint64(1) == 1


def components(links: DataFrame, a: str = "a", b: str = "b", name: str = "links", rounds: int = 60) -> DataFrame:
    """Connected components of an undirected link table, as (node, root) with the least node as root.

    Alternating large-star and small-star steps (Kiveris et al., 2014). Each step is
    an aggregate and a join, both on the node, so a hub is combined map-side and its
    join partition can be split by AQE; each round is stored in the shared folder.
    Only nodes with a link to another node appear.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where("u != v").distinct(), name)
    last = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v")))
                 .where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        edges = stored(small, name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not converge")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


#: A key with more than one in so many rows is joined apart; there are at most that many of them.
HOT_SHARE = 500
#: Rows that are looked at to find such keys.
LOOKED_AT = 200_000


def join_skewed(rows: DataFrame, found: DataFrame, key: str, found_key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``found`` (one row a key), safe from keys that hold much of ``rows``.

    A sample of ``rows`` (which should be a stored table) shows the hot keys; the ``found`` rows of these, at
    most ``HOT_SHARE``, are broadcast, all others are joined by a shuffle. The sample decides how a row is
    joined, never whether.
    """
    total = rows.count()
    look = rows.select(F.col(key).alias("k"))
    look = look if total <= LOOKED_AT else look.sample(LOOKED_AT / total, 7)
    least = max(100, min(total, LOOKED_AT) // HOT_SHARE)
    hot = [r["k"] for r in look.groupBy("k").count().where(F.col("count") > least).orderBy(F.desc("count"))
           .limit(HOT_SHARE).collect() if r["k"] is not None]
    same = F.col(key) == F.col(found_key)
    if not hot:
        return rows.join(found, same, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    found_hot = F.col(found_key).isin(hot)
    return rows.where(~is_hot).join(found.where(~found_hot), same, how).unionByName(
        rows.where(is_hot).join(F.broadcast(found.where(found_hot)), same, how))
