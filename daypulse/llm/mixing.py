"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a weight and a target: its share of all words, at most ``max_epochs``
times what it has, the excess shared out by weight again. A source's documents get
exponential keys ``-ln(u) / quality``; sorted by key, the prefix sums of their sizes decide
which of them fill the budget. Complete epochs come first: a target of 2.4 times the source
takes every document twice and the first 0.4 of the key order a third time.

The prefix sum over a source never runs in one task: keys are cut into ``KEY_BUCKETS``
buckets, bucket sums give each bucket's offset, and only the one bucket in which a
source's budget ends is put in order.

Defined results: a null or empty text has size 0 and is never taken; ``u`` depends on the
document's id and text and the seed only, so reruns agree; equal rows tie and are ordered
together with a row's rank among them deciding nothing but which copy is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm import textbatch as tb
from daypulse.llm.spark_utils import stored

KEY_BUCKETS = 4096
_LETTER = tb.byte_table([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
          seed: int = 0) -> DataFrame:
    """Per document: words, a quality weight in [0.1, 1] (the share of letters) and a uniform number.

    The uniform number comes from the id and the text, so that it can be drawn again.
    """
    ident = docs.schema[doc_id].dataType.simpleString()
    from_ = docs.schema[source].dataType.simpleString()
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"),
                       F.xxhash64(F.lit(seed), F.col(doc_id), F.col(source)).alias("h"))

    def run(batches):
        for b in batches:
            size, quality, name = [], [], []
            for s in tb.slices(b.column(2)):
                w = tb.words(s.data, s.offs)
                size.append(np.diff(w.first))
                inside = np.concatenate(([0], np.cumsum(tb.NON_SPACE[s.data], dtype=np.int64)))
                letters = np.concatenate(([0], np.cumsum(_LETTER[s.data], dtype=np.int64)))
                solid = inside[s.offs[1:]] - inside[s.offs[:-1]]
                alpha = letters[s.offs[1:]] - letters[s.offs[:-1]]
                quality.append(0.1 + 0.9 * alpha / np.maximum(solid, 1))
                name.append(tb.Rolling(s.data)(s.offs[:-1], s.offs[1:]))
            empty = [np.zeros(0)]
            h = b.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            u = tb.mix64(h ^ np.concatenate(name or empty).astype(np.uint64))
            u = ((u >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.concatenate(size or empty).astype(np.int64)),
                 pa.array(np.concatenate(quality or empty).astype(np.float64)), pa.array(u)],
                names=["doc_id", "source", "size", "quality", "u"])

    return slim.mapInArrow(run, f"doc_id {ident}, source {from_}, size long, quality double, u double")


def targets(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """Per source: its size and its target.

    Weights repeat over the sources in code point order, null last. Filling up: in the
    order of ``cap / weight`` the first sources are held at their cap until the common
    level of the rest no longer exceeds the next cap; that is where repeated sharing of
    the excess ends too. The table has one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", pick).withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    share = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", rest / share)
    # the first source whose cap is not below the level sets the level of all after it
    free = F.col("cap") >= F.col("level") * F.col("weight")
    level = F.first(F.when(free, F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    target = F.when(level.isNull(), F.col("cap").cast("double")).otherwise(
        F.least(level * F.col("weight"), F.col("cap").cast("double")))
    return per.select("source", F.col("source_size").cast("long").alias("source_size"), "weight", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3, seed: int = 0) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, epochs (times taken) and taken (words)."""
    sized = sizes(docs, doc_id, text, source, seed)
    key = -F.log(F.col("u")) / F.col("quality")
    # 1 - exp(-key * mean quality) is close to uniform, which makes the buckets even
    cut = F.least(F.floor((1 - F.exp(-key)) * KEY_BUCKETS), F.lit(KEY_BUCKETS - 1)).cast("int")
    sized = stored(sized.withColumn("key", key).withColumn("bucket", cut), "mix-sizes")
    plan = targets(sized, weights, max_epochs)
    ratio = F.col("target") / F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(ratio + 1e-12)).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn(
        "budget", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    plan = stored(plan, "mix-targets")

    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0)))
    sums = sums.withColumnRenamed("source", "s")
    plan2 = plan.withColumnRenamed("source", "p")
    # one row a source and bucket at most; the sources' table has one row a source
    part = sums.join(plan2, F.col("s").eqNullSafe(F.col("p"))).select(
        "s", F.col("bucket").alias("b"), "before", "source_size", "target", "whole", "budget",
        F.when(F.col("before") + F.col("words") <= F.col("budget"), "all")
        .when(F.col("before") >= F.col("budget"), "none").otherwise("edge").alias("how"))
    rows = sized.join(part, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    inner = Window.partitionBy("source", "bucket").orderBy("key", F.col("doc_id").asc_nulls_last())
    so_far = F.col("before") + F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    edge = rows.where("how = 'edge'").withColumn("extra", (so_far - F.col("size") / 2 <= F.col("budget")).cast("long"))
    flat = rows.where("how <> 'edge'").withColumn("extra", (F.col("how") == "all").cast("long"))
    return flat.unionByName(edge).select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0).alias("epochs"),
        (F.col("size") * (F.col("whole") + F.col("extra"))).alias("taken"))
