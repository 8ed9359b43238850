"""How filters interact: what each removes alone, after others, and in every order.

Five filters flag a document: too few words (A), too few distinct words (B), too many capitals (C),
symbols (D), and a copy of a text with a smaller id (E). A to D follow from the text alone and are
counted in one pass, which keeps no text. For E a counting Bloom filter goes ahead of the exact work:

* every task counts the cells of its own texts' names and hands on (cell, count) pairs, which are
  summed per cell, so a group of copies costs a task one row a cell;
* a text one of whose cells counts 1 is the only one of its kind. Only the others are shuffled, whole,
  grouped by full text for the least id (combined map-side: a task sends each text once);
* least ids go back to rows by a name of 128 bits; should two texts among the repeats ever share a
  name, their rows are joined by full text instead, so the flag is exact.

The sketch is cut by name into sections of at most ``SECTION`` rows, each with a bitmap of
``2^CELL_BITS`` cells (2 MB), so what is broadcast has a fixed size and the share of unique texts that
pass by chance stays the same at every scale. It never changes the result.

Flags make a mask of five bits; documents are counted by (part, mask), and everything else (any order,
step and share) follows from at most 32 counts a part.

Defined results: null text counts as empty; a null part is the empty string; a null id is no smaller
id and its row is a copy of nothing; rows with the same least id are all originals; an id that several
label rows name has every label that one of them gives; an empty table gives an empty table.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.llm import textbatch as tb
from daypulse.llm.spark_utils import join_skewed, passes, sieve, stored

LETTERS = "ABCDE"
CELL_BITS = 24
HASHES = 3
#: Rows of one section of the sketch: eight cells a row.
SECTION = 1 << (CELL_BITS - 3)
#: Cells that a task gathers before it hands on their counts.
GATHER = 1 << 20
_CAPITAL = tb.byte_table([(0x41, 0x5A)])
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#$%&*|", np.uint8))


def text_flags(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bits A to D (1, 2, 4, 8) of every text of a slice."""
    w = tb.words(data, offs)
    n = np.diff(w.first)

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[offs[1:]] - total[offs[:-1]]

    name = tb.word_hashes(data, w)
    order = np.lexsort((name, w.text))
    t, x = w.text[order], name[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (x[1:] != x[:-1])
    distinct = np.bincount(t[new], minlength=len(n))
    points = per_text((data & 0xC0) != 0x80)
    return ((n < 200) * 1 | (100 * distinct < 50 * n) * 2 | (100 * per_text(_CAPITAL[data]) > 3 * points) * 4
            | (per_text(_SYMBOL[data]) > 0) * 8)


def _names() -> list[Column]:
    return [F.xxhash64(F.lit(seed), F.col("text")).alias(f"name{seed}") for seed in (0, 1)]


def _rows(docs: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """doc_id, part, text (nulls as empty strings) and the two names of the text."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    return plain.select("*", *(F.xxhash64(F.lit(seed), F.col("text")).alias(f"name{seed}") for seed in (0, 1)))


def with_flags(rows: DataFrame, keep_text: bool = False) -> DataFrame:
    """The rows with bits A to D of their text as ``mask``."""
    keep = [f for f in rows.schema.fields if keep_text or f.name != "text"]
    schema = T.StructType([*keep, T.StructField("mask", T.IntegerType())])
    at = rows.columns.index("text")

    def run(batches):
        for b in batches:
            got = [text_flags(s.data, s.offs) for s in tb.slices(b.column(at))]
            flags = np.concatenate(got) if got else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(f.name)) for f in keep]
                                             + [pa.array(flags.astype(np.int32))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _cells(name: np.ndarray) -> np.ndarray:
    """The cells of each name, one row a hash."""
    mask = np.uint64((1 << CELL_BITS) - 1)
    return np.stack([(tb.mix64(name.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64))) & mask)
                     .view(np.int64) for k in range(HASHES)])


def repeated_cells(names: DataFrame) -> DataFrame:
    """The cells that count two rows or more, from per-task sketches that are merged by cell."""
    def run(batches):
        held, n = [], 0

        def sketch():
            cell, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.minimum(count, 2))], names=["cell", "n"])

        for b in batches:
            held.append(_cells(b.column(0).to_numpy(zero_copy_only=False)).ravel())
            n += len(held[-1])
            if n >= GATHER:
                yield sketch()
                held, n = [], 0
        if n:
            yield sketch()

    cells = names.mapInArrow(run, "cell long, n long")
    return cells.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").select("cell")


def _passing(table) -> Column:
    """A filter on a name: all of its cells are in the broadcast bitmap. Only the name leaves the JVM."""
    @F.pandas_udf("boolean")
    def all_cells(name):
        return pd.Series(np.logical_and.reduce([passes(table.value, c) for c in _cells(name.to_numpy())]))

    return all_cells("name0")


def possible_repeats(rows: DataFrame, narrow: DataFrame, section: int = SECTION) -> DataFrame:
    """The rows that the sketch of ``narrow`` (the same rows without their texts) cannot clear."""
    sections = max(1, -(-narrow.count() // section))
    out = None
    for k in range(sections):
        mine = F.pmod(F.col("name1"), F.lit(sections)) == k
        table = sieve(repeated_cells(narrow.where(mine).select("name0")), "cell", CELL_BITS)
        some = rows.where(mine).where(_passing(table))
        out = some if out is None else out.unionByName(some)
    return out


def least_ids(rows: DataFrame, narrow: DataFrame, section: int = SECTION) -> DataFrame:
    """The texts that occur twice or more, with their names and ``least``, the least id: grouped by full text."""
    groups = (possible_repeats(rows, narrow, section).groupBy("text", "name0", "name1")
              .agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    return stored(groups.where("n > 1").drop("n"), "repeats")


def flagged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
            section: int = SECTION) -> DataFrame:
    """One row a document: doc_id, part and ``mask`` (bits A to E from the lowest)."""
    rows = _rows(docs, doc_id, text, part)
    narrow = stored(with_flags(rows), "flags")
    groups = least_ids(rows, narrow, section)
    names = ["name0", "name1"]
    shared = stored(groups.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select(*names), "shared-names")
    copy = F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False)).cast("int") * 16
    out = ["doc_id", "part", (F.col("mask") + copy).alias("mask")]
    odd = None
    if not shared.isEmpty():  # different texts under one name: these rows are joined by full text
        texts = rows.join(shared, names, "left_semi")
        odd = with_flags(texts, keep_text=True).join(groups.select("text", "least"), "text", "left").select(*out)
        narrow, groups = narrow.join(shared, names, "left_anti"), groups.join(shared, names, "left_anti")
    key = F.concat_ws(":", *names)
    seen = sieve(groups.select("name0"), "name0")

    @F.pandas_udf("boolean")
    def repeated(name):
        return pd.Series(passes(seen.value, name.to_numpy()))

    marked = narrow.withColumn("__name", key).withColumn("__may", repeated("name0"))
    found = join_skewed(marked.where("__may"), groups.select(key.alias("__key"), "least"), "__name", "__key", "left")
    done = marked.where("not __may").select("doc_id", "part", "mask").unionByName(found.select(*out))
    return done if odd is None else done.unionByName(odd)


def mask_counts(marks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask) with the documents, those of good quality and the toxic ones: additive counts."""
    named = (labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("__good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("__toxic")))
    joined = join_skewed(marks.where("doc_id is not null"), named, "doc_id", "__id", "left")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    rows = joined.select("part", "mask", F.coalesce("__good", F.lit(0)).alias("good"), F.coalesce("__toxic", F.lit(0)).alias("toxic"))
    none = marks.where("doc_id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))  # no label
    return rows.unionByName(none).groupBy("part", "mask").agg(
        F.count("*").alias("n"), count("good").alias("good"), count("toxic").alias("toxic"))


def every_order(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, from counts by mask."""
    orders = ["".join(p) for p in permutations(letters)]
    rows = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))  # 2^5 at most
    rows = rows.withColumn("filter_order", F.explode(F.split(F.lit(",".join(orders)), ",")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    bit = lambda x: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(letters), x) - 1)
    bits = F.transform(F.split("filter_order", "(?<=.)(?=.)"), bit)
    rows = rows.withColumn("bits", bits).withColumn("own", F.element_at("bits", F.col("step")))
    rows = rows.withColumn("before", F.aggregate(F.slice("bits", 1, F.col("step") - 1), F.lit(0), lambda a, x: a + x))
    own, before = F.col("own"), F.col("before")

    def total(test, value=lambda x: x["n"]):
        return F.aggregate("m", F.lit(0).cast("long"), lambda acc, x: F.when(test(x["mask"]), acc + value(x)).otherwise(acc))

    has = lambda mask, bits: mask.bitwiseAND(bits) != 0
    gone = lambda mask: has(mask, own) & ~has(mask, before)
    return rows.select(
        "part", "filter_order", "step",
        total(lambda k: ~has(k, own) & ~has(k, before)).alias("kept"), total(gone).alias("removed"),
        total(lambda k: has(k, own) & has(k, before)).alias("redundant"), total(lambda k: k == own).alias("unique_fails"),
        total(gone, lambda x: x["good"]).alias("good_lost"), total(gone, lambda x: x["toxic"]).alias("toxic_lost"),
        # of the filters that a document fails, each comes first in an equal share of the orders
        total(lambda k: has(k, own), lambda x: x["n"] * (F.lit(len(orders)) / F.bit_count(x["mask"])).cast("long")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang",
          section: int = SECTION) -> DataFrame:
    """The table of all orders and steps for each part of ``docs``."""
    marks = stored(flagged(docs, doc_id, text, part, section), "masks")
    return every_order(mask_counts(marks, labels))
