"""Quality rules with host-level verdicts.

Each document gets plain counts and rule results. Rule failures are then aggregated by
host (here: any host column, such as the source), each host's failure rate is shrunk
towards the corpus rate with a beta prior fitted to all hosts by the method of moments,
and hosts whose shrunk rate stands out are judged *strict*. The verdict is joined back:
on a strict host a document that fails any soft rule goes; a document that fails no rule
stays wherever it comes from.

Defined results: null or empty text counts as no words; a null host is a host of its own;
repeated rows are judged each on its own; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.llm import textbatch as tb
from daypulse.llm.spark_utils import stored

#: Hosts are broadcast up to this many rows (some 100 bytes each), joined by salted shuffle beyond.
HOST_BROADCAST_ROWS = 200_000
SALTS = 32
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    """Thresholds; shares are in percent of words unless the name says otherwise."""

    min_words: int = 50
    max_repeat_pct: int = 50
    soft_repeat_pct: int = 30
    soft_symbol_pct: int = 50
    soft_dup_lines_per_mille: int = 30
    min_mean_chars: int = 2
    max_mean_chars: int = 25
    strict_factor: float = 1.5
    strict_floor: float = 0.1


def measure_slice(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every text of a slice."""
    texts = len(offs) - 1
    w = tb.words(data, offs)
    n_words = np.diff(w.first)

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[offs[1:]] - total[offs[:-1]]

    in_word = tb.NON_SPACE[data]
    word_chars = per_text(in_word & ((data & 0xC0) != 0x80))
    n_symbols = per_text(_SYMBOLS[data])

    roll = tb.Rolling(data)
    filled = np.flatnonzero(offs[1:] > offs[:-1])
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate((offs[:-1][filled], breaks + 1)))
    end = np.sort(np.concatenate((offs[1:][filled], breaks)))
    solid = np.concatenate(([0], np.cumsum(in_word, dtype=np.int64)))
    live = solid[end] > solid[start]
    start, end = start[live], end[live]
    line_text = np.searchsorted(offs, start, side="right") - 1
    _, seen_again = _repeats(line_text, roll(start, end))
    n_dup_lines = np.bincount(line_text[seen_again], minlength=texts)

    marked = np.zeros(len(w.start), bool)
    if len(w.start) >= 3:
        i = np.flatnonzero(w.text[:-2] == w.text[2:])
        grams = tb.Rolling(roll(w.start, w.end))(i, i + 3)
        many, _ = _repeats(w.text[i], grams)
        hit = i[many]
        marked[hit] = marked[hit + 1] = marked[hit + 2] = True
    n_repeat = np.bincount(w.text[marked], minlength=texts)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
            "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat}


def _repeats(text: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of (text, name) pairs in order: occurs more than once; equals an earlier one."""
    order = np.argsort(tb.mix64(name + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    t, x = text[order], name[order]
    same = (t[1:] == t[:-1]) & (x[1:] == x[:-1])
    later = np.zeros(len(text), bool)
    later[order[1:][same]] = True
    many = later.copy()
    many[order[:-1][same]] = True
    return many, later


def with_measures(docs: DataFrame, text: str = "text", prefix: str = "", drop_text: bool = False) -> DataFrame:
    """The rows of ``docs`` with the counts as further long columns named ``prefix + measure``."""
    keep = [f for f in docs.schema.fields if not (drop_text and f.name == text)]
    schema = T.StructType([*keep, *(T.StructField(prefix + m, T.LongType()) for m in MEASURES)])

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            parts = [measure_slice(s.data, s.offs) for s in tb.slices(column)]
            counts = [np.concatenate([p[m] for p in parts]) if parts else np.zeros(0, np.int64) for m in MEASURES]
            names = [f.name for f in keep] + [prefix + m for m in MEASURES]
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(c, pa.int64()) for c in counts], names=names)

    return docs.mapInArrow(run, schema)


def base_failed(r: Rules = Rules(), prefix: str = "") -> Column:
    n, rep = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < r.min_words) | (rep * 100 > n * r.max_repeat_pct)


def soft_failed(r: Rules = Rules(), prefix: str = "") -> Column:
    """Any rule that alone is no ground for rejection."""
    c = lambda m: F.col(prefix + m)
    return (base_failed(r, prefix) | (c("n_repeat_words") * 100 > c("n_words") * r.soft_repeat_pct)
            | (c("n_symbols") * 100 > c("n_words") * r.soft_symbol_pct)
            | (c("n_dup_lines") * 1000 > c("n_words") * r.soft_dup_lines_per_mille)
            | (c("word_chars") < c("n_words") * r.min_mean_chars)
            | (c("word_chars") > c("n_words") * r.max_mean_chars))


def host_verdicts(measured: DataFrame, host: str, r: Rules = Rules(), prefix: str = "") -> DataFrame:
    """One row per host: n, failed, shrunk rate and ``strict``.

    Only counts per host are gathered, combined map-side, so a host with a third of
    all rows costs its tasks one row each.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), F.sum(soft_failed(r, prefix).cast("long")).alias("failed"))
    rate = F.col("failed") / F.col("n")
    prior = hosts.agg((F.sum("failed") / F.sum("n")).alias("m"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("v"))
    m, v = F.col("m"), F.col("v")
    size = F.when(v > 0, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(2.0)), F.lit(10000.0))).otherwise(10000.0)
    prior = prior.select("m", size.alias("size"))
    shrunk = (F.col("failed") + m * F.col("size")) / (F.col("n") + F.col("size"))
    # the prior is one row (two global sums), so this broadcast has a fixed size
    return hosts.join(F.broadcast(prior)).select(
        "host", "n", "failed", shrunk.alias("rate"),
        ((shrunk >= m * r.strict_factor) & (shrunk >= r.strict_floor)).alias("strict"))


def join_verdicts(measured: DataFrame, verdicts: DataFrame, host: str, r: Rules = Rules(), prefix: str = "",
                  out: str = "kept") -> DataFrame:
    """``measured`` with the boolean ``out``: false on a base failure or a soft failure on a strict host."""
    strict = stored(verdicts.where("strict").select(F.col("host").alias("__host")), "hosts")
    few = strict.limit(HOST_BROADCAST_ROWS + 1).count() <= HOST_BROADCAST_ROWS
    strict = strict.withColumn("__strict", F.lit(True))
    same = F.col(host).eqNullSafe(F.col("__host"))
    if few:
        joined = measured.join(F.broadcast(strict), same, "left")
    else:  # salt the hot hosts: each verdict is copied SALTS times
        salted = strict.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = (measured.withColumn("__mysalt", (F.rand(7) * SALTS).cast("int"))
                  .join(salted, same & (F.col("__mysalt") == F.col("__salt")), "left").drop("__mysalt", "__salt"))
    keep = ~(base_failed(r, prefix) | (soft_failed(r, prefix) & F.col("__strict").isNotNull()))
    return joined.withColumn(out, keep).drop("__host", "__strict")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          r: Rules = Rules()) -> DataFrame:
    """Per document: its id, the counts, base_failed and kept."""
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("__from"))
    measured = stored(with_measures(plain, drop_text=True), "measures")
    judged = join_verdicts(measured, host_verdicts(measured, "__from", r), "__from", r)
    return judged.select("doc_id", *MEASURES, base_failed(r).alias("base_failed"), "kept")


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", r: Rules = Rules()) -> DataFrame:
    """The documents that are kept, with their own columns."""
    p = "__q_"
    slim = docs.select(F.col(text).alias("text"), F.col(host).alias("__from"))
    verdicts = host_verdicts(with_measures(slim, prefix=p, drop_text=True), "__from", r, p)
    judged = join_verdicts(with_measures(docs, text, p), verdicts, host, r, p, "__q_kept")
    return judged.where("__q_kept").select(*[F.col(f"`{c}`") for c in docs.columns])
