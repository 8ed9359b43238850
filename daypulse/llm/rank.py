"""Ranked lexical search by presence-mask grouping.

Every item (query) ranks all documents by an integer BM25-like score over its terms. One pass over the
texts keeps, of each document, its length and its counts of terms that some item has; document
frequencies come from these by an aggregate. The table of counts is then searched block by block:

* every term of a block has a bitmap of the documents that hold it. An item's terms are taken by
  descending best contribution in the block; ``bitmap & ~seen`` are the documents whose best term it is,
  and the bitmaps of the later terms cut them into groups by matched-term mask;
* a mask's maximum score is the sum of its terms' best contributions. Masks are evaluated by descending
  maximum; terms not yet opened bound everything that is still to come. The search of a block ends once
  the ``top``-th score found so far (also in earlier blocks of the task) is above all that is left. An
  equal bound goes on, as a smaller id may win the tie.

Each task hands on at most ``top`` documents an item; a window per item, limited map-side, ranks these.

Items are read in blocks of at most ``ITEM_BYTES`` of text, each broadcast with its vocabulary and
searched in a pass of its own over the documents, so neither side needs to fit anywhere (one item must).
Terms are told apart by two names modulo 2^61 - 1 (see ``textbatch.Rolling``): the chance that any two
of t different terms of l bytes are confused is below (t * l)^2 / 2^122.

Defined results: null, empty and termless texts match nothing; benchmark rows are ranked each on its own,
also where they share an id; repeated document rows take a rank each; of equal scores the smaller id goes
first, a null id last; empty tables give an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daypulse.llm import textbatch as tb
from daypulse.llm.spark_utils import stored

ITEM_BYTES = 32 << 20
#: Documents of a block; a bitmap has this many bits.
BLOCK_DOCS = 1 << 16
#: Documents that are scored at once.
CHUNK = 256
#: Bitmaps of a block that are kept (8 kB each).
KEPT_BITMAPS = 4096
_NONE = np.iinfo(np.int64).max


@dataclass
class Items:
    """Items of one block: ids, and each one's term codes and repeats; the vocabulary's names by code."""

    ids: list
    codes: list
    reps: list
    names: np.ndarray
    check: np.ndarray


def _terms(data: np.ndarray, offs: np.ndarray) -> tuple[tb.Words, np.ndarray, np.ndarray]:
    data = tb.LOWER[data]
    w = tb.words(data, offs, tb.ALNUM_LOWER)
    return w, tb.word_hashes(data, w), tb.word_hashes(data, w, 1)


def read_items(ids: list, texts: list) -> Items:
    first, name, check = [0], [], []
    for s in tb.slices(pa.array(texts, pa.large_string())):
        w, a, b = _terms(s.data, s.offs)
        first.extend((first[-1] + w.first[1:]).tolist())
        name.append(a)
        check.append(b)
    name = np.concatenate(name) if name else np.zeros(0, np.uint64)
    check = np.concatenate(check) if check else np.zeros(0, np.uint64)
    names, at, code = np.unique(name, return_index=True, return_inverse=True)
    if (check[at][code] != check).any():
        raise ValueError("two terms share a name")
    got = [np.unique(code[s:e], return_counts=True) for s, e in zip(first, first[1:])]
    return Items(ids, [c for c, _ in got], [r for _, r in got], names, check[at])


def count_slice(items: Items, data: np.ndarray, offs: np.ndarray):
    """Of every text: number of terms; and (text, code, tf) of the items' terms, sorted."""
    w, name, check = _terms(data, offs)
    at = np.searchsorted(items.names, name)
    at[at == len(items.names)] = 0
    known = (items.names[at] == name) & (items.check[at] == check) if len(items.names) else np.zeros(len(name), bool)
    pair = w.text[known].astype(np.int64) * max(len(items.names), 1) + at[known]
    pair, tf = np.unique(pair, return_counts=True)
    return np.diff(w.first), pair // max(len(items.names), 1), pair % max(len(items.names), 1), tf


def with_counts(docs: DataFrame, items) -> DataFrame:
    """doc_id, n, codes, tfs of every row of ``docs`` (doc_id, text) that has a term at all."""
    kind = pa.list_(pa.int32())

    def run(batches):
        for b in batches:
            for s in tb.slices(b.column(1)):
                n, row, code, tf = count_slice(items.value, s.data, s.offs)
                first = np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(first), pa.array(x.astype(np.int32))) for x in (code, tf)]
                out = pa.RecordBatch.from_arrays([b.column(0).slice(s.first, len(n)), pa.array(n.astype(np.int64)),
                                                  lists[0].cast(kind), lists[1].cast(kind)], names=["doc_id", "n", "codes", "tfs"])
                yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(run, "doc_id long, n long, codes array<int>, tfs array<int>")


@dataclass
class Block:
    """Documents of a block and, for each code, the sorted documents that hold it with their contributions."""

    ids: np.ndarray
    codes: np.ndarray
    first: np.ndarray
    docs: np.ndarray
    gain: np.ndarray
    best: np.ndarray
    bitmaps: dict = field(default_factory=dict)

    def rows(self, code: int) -> slice | None:
        at = int(np.searchsorted(self.codes, code))
        return slice(self.first[at], self.first[at + 1]) if at < len(self.codes) and self.codes[at] == code else None

    def bitmap(self, code: int) -> np.ndarray:
        have = self.bitmaps.get(code)
        if have is None:
            if len(self.bitmaps) >= KEPT_BITMAPS:
                self.bitmaps.clear()
            bits = np.zeros(len(self.ids), bool)
            bits[self.docs[self.rows(code)]] = True
            have = self.bitmaps[code] = np.packbits(bits)
        return have


def make_block(ids, n, lengths, codes, tfs, weight: np.ndarray, total_docs: int, total_terms: int) -> Block:
    doc = np.repeat(np.arange(len(n)), lengths)
    if 75 * int(n.max(initial=0)) * total_docs < _NONE:
        m = 25 + (75 * n * total_docs) // total_terms
    else:
        m = np.array([25 + (75 * int(x) * total_docs) // total_terms for x in n], np.int64)
    gain = weight[codes] * ((1000000000 * tfs) // (1000 * tfs + 8 * m[doc]))
    order = np.argsort(codes, kind="stable")
    codes, doc, gain = codes[order], doc[order], gain[order]
    uniq, first = np.unique(codes, return_index=True)
    best = np.maximum.reduceat(gain, first) if len(uniq) else np.zeros(0, np.int64)
    return Block(ids, uniq, np.append(first, len(codes)), doc, gain, best)


class Best:
    """The ``top`` best documents of one item so far."""

    def __init__(self, top: int):
        self.top, self.score, self.ids = top, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def bar(self) -> int:
        """No document with a lower score can enter."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        live = score >= self.bar
        score, ids = np.concatenate((self.score, score[live])), np.concatenate((self.ids, ids[live]))
        order = np.lexsort((ids, -score))[:self.top]
        self.score, self.ids = score[order], ids[order]


def search_block(block: Block, codes: np.ndarray, reps: np.ndarray, best: Best, chunk: int = CHUNK) -> int:
    """Enter the block's documents for one item; returns how many were scored."""
    at = np.searchsorted(block.codes, codes)
    at[at == len(block.codes)] = 0
    there = block.codes[at] == codes if len(block.codes) else np.zeros(len(codes), bool)
    peak = block.best[at[there]] * reps[there]
    order = np.argsort(-peak, kind="stable")
    order = order[peak[order] > 0]
    terms, times, peak = codes[there][order], reps[there][order], peak[order]
    left = np.append(np.cumsum(peak[::-1])[::-1], 0)  # the most that a document can score whose best term is this one
    seen = np.zeros((len(block.ids) + 7) // 8, np.uint8)
    bound, where = np.zeros(0, np.int64), np.zeros(0, np.int64)  # masks that are open, by descending maximum
    j = scored = 0
    while True:
        while len(bound) and bound[0] >= max(int(left[j]), best.bar):
            n = min(chunk, int(np.searchsorted(-bound, -max(int(left[j]), best.bar), side="right")))
            n = int(np.searchsorted(-bound, -bound[n - 1], side="right"))  # whole masks
            best.add(_scores(block, terms, times, where[:n]), block.ids[where[:n]])
            scored += n
            bound, where = bound[n:], where[n:]
        if j == len(terms) or left[j] < best.bar:
            return scored
        new = block.bitmap(int(terms[j])) & ~seen
        seen |= new
        here = np.flatnonzero(np.unpackbits(new, count=len(block.ids)))
        j += 1
        if len(here):
            byte, bit = here >> 3, (7 - (here & 7)).astype(np.uint8)
            held = np.empty((len(here), len(terms) - j + 1), np.uint8)
            held[:, 0] = 1
            for i in range(j, len(terms)):
                held[:, i - j + 1] = (block.bitmap(int(terms[i]))[byte] >> bit) & 1
            rows = np.packbits(held, axis=1)
            _, some, group = np.unique(rows.view(np.dtype((np.void, rows.shape[1]))).ravel(), return_index=True, return_inverse=True)
            most = held[some].astype(np.int64) @ peak[j - 1:]
            most = most[group]
            live = most >= best.bar
            bound, where = np.concatenate((bound, most[live])), np.concatenate((where, here[live]))
            order = np.lexsort((where, -bound))
            bound, where = bound[order], where[order]


def _scores(block: Block, terms: np.ndarray, times: np.ndarray, docs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(docs), np.int64)
    for code, reps in zip(terms, times):
        rows = block.rows(int(code))
        held, gain = block.docs[rows], block.gain[rows]
        at = np.searchsorted(held, docs)
        at[at == len(held)] = 0
        total += np.where(held[at] == docs, gain[at], 0) * reps
    return total


def _search(counts: DataFrame, items, weight, total_docs: int, total_terms: int, top: int, block_docs: int) -> DataFrame:
    """(i, doc_id, score): each task's ``top`` documents of every item; i is the item's place."""
    def run(batches):
        best = [Best(top) for _ in items.value.ids]

        def finish(parts):
            ids = pa.concat_arrays([p.column(0) for p in parts])
            n = np.concatenate([p.column(1).to_numpy() for p in parts])
            codes, tfs = (pa.concat_arrays([p.column(k) for p in parts]) for k in (2, 3))
            block = make_block(ids.fill_null(_NONE).to_numpy(), n, codes.value_lengths().to_numpy(),
                               codes.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64),
                               weight.value, total_docs, total_terms)
            for c, r, b in zip(items.value.codes, items.value.reps, best):
                search_block(block, c, r, b)

        held, n = [], 0
        for b in batches:
            while b.num_rows:
                part = b.slice(0, block_docs - n)
                held.append(part)
                n += part.num_rows
                b = b.slice(part.num_rows)
                if n == block_docs:
                    finish(held)
                    held, n = [], 0
        if held:
            finish(held)
        i = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        ids = np.concatenate([b.ids for b in best]) if best else np.zeros(0, np.int64)
        score = np.concatenate([b.score for b in best]) if best else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(ids, mask=ids == _NONE), pa.array(score)],
                                         names=["i", "doc_id", "score"])

    return counts.mapInArrow(run, "i long, doc_id long, score long")


def top_documents(docs: DataFrame, benchmark: DataFrame, top: int = 10, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES,
                  block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``top`` documents with a score above 0."""
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    size = bench.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-int(size) // item_bytes))
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    kind = bench.schema["item_id"].dataType.simpleString()
    out = None
    for k in range(blocks):
        mine = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        got = mine.orderBy("item_id", "text").collect()  # at most item_bytes of text
        items = spark.sparkContext.broadcast(read_items([r.item_id for r in got], [r.text for r in got]))
        counts = stored(with_counts(plain, items), "term-counts")
        total = counts.agg(F.count("*"), F.sum("n")).first()
        held = counts.select(F.explode("codes").alias("c")).groupBy("c").agg(F.count("*").alias("df")).toArrow()
        df = np.zeros(max(len(items.value.names), 1), np.int64)  # one entry a term of the items
        df[held["c"].to_numpy()] = held["df"].to_numpy()
        weight = [math.floor(1000 * math.log((2 * total[0] + 2) / (2 * int(x) + 1))) for x in df]
        found = _search(counts, items, spark.sparkContext.broadcast(np.array(weight, np.int64)), int(total[0]),
                        int(total[1] or 1), top, block_docs)
        place = Window.partitionBy("i").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(got)], f"i long, item_id {kind}")
        ranked = ranked.join(names, "i").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    return out
