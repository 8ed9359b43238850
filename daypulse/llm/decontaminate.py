"""Benchmark decontamination by winnowing.

Each text's words are hashed, k-grams of words named, and of each run of consecutive k-grams
that make up one window the least name is kept as a fingerprint. Equal windows keep equal
fingerprints, so joining training and benchmark fingerprints finds every shared span of a
window's length. A hit is extended to the whole windows around it and those are compared.

The benchmark is cut into blocks of at most ``BLOCK_BYTES`` of text; each block's fingerprints
are joined as a broadcast of that bounded size with all documents, and blocks are merged per
document, so neither side needs to fit anywhere.

Defined results: a null text has no words; an item with fewer words than a window is one window
itself (and its own fingerprint); an item without words never occurs; items are told apart by
item_id (null: shown as an empty id); repeated document rows give repeated rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.llm import textbatch as tb

BLOCK_BYTES = 32 << 20
_FILTER_BITS = 20


@dataclass
class Table:
    """Sorted window names with the items (rows of ``ids``) that have them."""

    names: np.ndarray
    first: np.ndarray
    items: np.ndarray


@dataclass
class Index:
    ids: np.ndarray
    prints: np.ndarray
    sieve: np.ndarray
    full: Table | None
    short: dict[int, Table]


def _table(names: np.ndarray, items: np.ndarray) -> Table:
    order = np.lexsort((items, names))
    names, items = names[order], items[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (items[1:] != items[:-1])
    names, items = names[new], items[new]
    uniq, first = np.unique(names, return_index=True)
    return Table(uniq, np.append(first, len(names)), items)


def _hashes(data: np.ndarray, offs: np.ndarray) -> tuple[tb.Words, np.ndarray]:
    data = tb.LOWER[data]
    w = tb.words(data, offs, tb.ALNUM_LOWER)
    return w, tb.word_hashes(data, w)


def _whole(first: np.ndarray, size: int) -> np.ndarray:
    """Starts of all windows of ``size`` words that lie within one text."""
    n = int(first[-1])
    ok = np.zeros(n + 1, np.int64)
    room = np.diff(first) >= size
    np.add.at(ok, first[:-1][room], 1)
    np.add.at(ok, first[1:][room] - size + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:n]) > 0)


def _prints(h: np.ndarray, starts: np.ndarray, window: int, k: int) -> np.ndarray:
    """The fingerprint of each window: the least name among its k-grams."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    i = np.arange(len(h) - k + 1)
    return tb.sliding_min(tb.Rolling(h)(i, i + k), window - k + 1)[starts]


def build_index(ids: list, texts: list, window: int, k: int) -> Index:
    ids = np.array(["" if x is None else str(x) for x in ids], dtype=object)
    uniq, code = np.unique(ids.astype(str), return_inverse=True) if len(ids) else (ids, np.zeros(0, np.int64))
    column = pa.array(texts, pa.large_string())
    names, items, prints, short = [], [], [], {}
    for s in tb.slices(column, 1 << 62):
        w, h = _hashes(s.data, s.offs)
        count = np.diff(w.first)
        starts = _whole(w.first, window)
        roll = tb.Rolling(h)
        names.append(roll(starts, starts + window))
        items.append(code[w.text[starts]])
        prints.append(_prints(h, starts, window, k))
        for m in range(1, window):
            rows = np.flatnonzero(count == m)
            if len(rows):
                at = w.first[rows]
                short[m] = _table(roll(at, at + m), code[rows])
    prints = np.unique(np.concatenate(prints or [np.zeros(0, np.uint64)]))
    sieve = np.zeros(1 << (_FILTER_BITS - 6), np.uint64)
    low = prints & np.uint64((1 << _FILTER_BITS) - 1)
    np.bitwise_or.at(sieve, (low >> np.uint64(6)).astype(np.int64), np.uint64(1) << (low & np.uint64(63)))
    full = _table(np.concatenate(names), np.concatenate(items)) if len(prints) else None
    return Index(uniq, prints, sieve, full, short)


def _find(table: Table, names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, row of ``table.names``) of the names that are in the table."""
    at = np.searchsorted(table.names, names)
    at[at == len(table.names)] = 0
    ok = table.names[at] == names
    return starts[ok], at[ok]


def match_slice(index: Index, data: np.ndarray, offs: np.ndarray, window: int, k: int):
    """Words, hit ranges (word start, end) and (text, item) pairs of a slice."""
    w, h = _hashes(data, offs)
    roll = tb.Rolling(h)
    begin, stop, pair_text, pair_item = [], [], [], []

    def add(table: Table, starts: np.ndarray, size: int) -> None:
        at, row = _find(table, roll(starts, starts + size), starts)
        begin.append(at)
        stop.append(at + size)
        many = table.first[row + 1] - table.first[row]
        pair_text.append(np.repeat(w.text[at], many))
        skip = np.repeat(np.cumsum(many) - many, many)
        pair_item.append(table.items[np.repeat(table.first[row], many) + np.arange(many.sum()) - skip])

    if index.full is not None:
        starts = _whole(w.first, window)
        fp = _prints(h, starts, window, k)
        low = fp & np.uint64((1 << _FILTER_BITS) - 1)
        maybe = (index.sieve[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) == 1
        starts, fp = starts[maybe], fp[maybe]
        at = np.searchsorted(index.prints, fp)
        at[at == len(index.prints)] = 0
        starts = starts[index.prints[at] == fp]
        add(index.full, starts, window)  # extend the hits: compare the windows they lie in
    for m, table in index.short.items():
        add(table, _whole(w.first, m), m)
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    pairs = np.unique(np.stack((join(pair_text), join(pair_item))), axis=1)
    return w, join(begin), join(stop), pairs


_OUT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _digest(items) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 10, k: int = 5, prefix: str = "",
                  drop_text: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated (named ``prefix + ...``)."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t"))
    total = bench.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    keep = [f for f in docs.schema.fields if not (drop_text and f.name == text)]
    out = T._parse_datatype_string(_OUT)
    schema = T.StructType([*keep, *(T.StructField(prefix + f.name, f.dataType) for f in out.fields)])
    names = [f.name for f in schema.fields]

    def broadcast(rows: DataFrame):
        got = rows.collect()  # at most block_bytes of text
        return spark.sparkContext.broadcast(build_index([r.i for r in got], [r.t for r in got], window, k))

    if blocks == 1:
        index = broadcast(bench)

        def run(batches):
            for b in batches:
                cols = [[], [], [], []]
                for s in tb.slices(b.column(b.schema.get_field_index(text))):
                    w, begin, stop, pairs = match_slice(index.value, s.data, s.offs, window, k)
                    hit = tb.ranges_to_mask(begin, stop, len(w.start))
                    n = len(s.offs) - 1
                    cols[0].append(np.diff(w.first))
                    cols[1].append(np.bincount(w.text[hit], minlength=n))
                    n_items = np.bincount(pairs[0], minlength=n)
                    cols[2].append(n_items)
                    digest = np.full(n, _digest([]), dtype=object)
                    cut = np.concatenate(([0], np.cumsum(n_items)))
                    for i in np.flatnonzero(n_items):
                        digest[i] = _digest(index.value.ids[pairs[1][cut[i]:cut[i + 1]]])
                    cols[3].append(digest)
                a = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols]
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index(f.name)) for f in keep]
                    + [pa.array(x.astype(np.int64)) for x in a[:3]]
                    + [pa.array(list(a[3]), pa.string()), pa.array(a[1] > 0)], names=names)

        return docs.mapInArrow(run, schema)

    # more than one block: hits of each block by text, merged per text, joined back to the rows
    named = docs.withColumn("__name", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    hits = None
    for block in range(blocks):
        index = broadcast(bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block))

        def run_block(batches, index=index):
            for b in batches:
                names_, begins, stops, ids = b.column(0).to_pylist(), [], [], []
                for s in tb.slices(b.column(1)):
                    w, begin, stop, pairs = match_slice(index.value, s.data, s.offs, window, k)
                    owner = w.text[begin] if len(begin) else begin
                    for i in range(len(s.offs) - 1):
                        mine = owner == i
                        begins.append((begin[mine] - w.first[i]).tolist())
                        stops.append((stop[mine] - w.first[i]).tolist())
                        ids.append(index.value.ids[pairs[1][pairs[0] == i]].tolist())
                yield pa.RecordBatch.from_pydict({"n": names_, "b": begins, "e": stops, "ids": ids}, pa.schema(
                    [("n", pa.string()), ("b", pa.list_(pa.int64())), ("e", pa.list_(pa.int64())),
                     ("ids", pa.list_(pa.string()))]))

        found = named.select("__name", F.col(text)).mapInArrow(
            run_block, "n string, b array<long>, e array<long>, ids array<string>").where("size(b) > 0").select(
            "n", F.arrays_zip("b", "e").alias("hit"), "ids")  # each begin stays with its own end
        hits = found if hits is None else hits.unionByName(found)
    merged = hits.groupBy(F.col("n").alias("__hit_name")).agg(
        F.array_distinct(F.flatten(F.collect_set("hit"))).alias("hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("ids"))
    word = lambda c: F.size(F.regexp_extract_all(F.translate(
        F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(0)))

    rows = named.join(merged, F.col("__name") == F.col("__hit_name"), "left")
    none = F.array().cast("array<struct<b: bigint, e: bigint>>")
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        F.coalesce("hit", none), lambda x: F.sequence(x["b"], x["e"] - 1)))))
    ids = F.coalesce(F.col("ids"), F.array().cast("array<string>"))
    return rows.select(*[F.col(f"`{f.name}`") for f in keep], word(text).cast("long").alias(prefix + "n_words"),
                       covered.cast("long").alias(prefix + "n_hit"), F.size(ids).cast("long").alias(prefix + "n_items"),
                       F.sha2(F.array_join(ids, ","), 256).alias(prefix + "items_sha256"),
                       (covered > 0).alias(prefix + "contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    marked = decontaminate(docs, benchmark, prefix="__b_", **options)
    return marked.where("not __b_contaminated").select(*[F.col(f"`{c}`") for c in docs.columns])
