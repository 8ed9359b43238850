"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles. All sets share one token order: tokens known to be frequent
last (by count), the others by name. Two sets with similarity ``t`` or more share at least
``l`` tokens among the first ``n - ceil(t * n) + l`` of each (AdaptJoin; Wang et al., 2012).
A document lengthens its prefix to the ``l`` with the least estimated cost - entries read in
the token lists plus candidates to verify, which drop with ``l`` as each must bring ``l``
matches - so a pair must share the smaller ``l`` of its two documents before it is verified,
and as many more as its sizes demand.

Equal sets are one node from the start. Groups of near copies are linked without listing their
pairs: first every token list links its documents to one pivot per size band (the document with
the fewest tokens of its own, the same one in most of a group's lists), those are verified and
joined into components; then only pairs from different components are listed. Every link
between different components is found, so components are exact.

Defined results: a text with fewer words than a shingle is one shingle, a text without words
(or null) has none and links with nothing; a null doc_id never names a component (a component
of null ids only has a null id); repeated rows get equal results. Rows that share a doc_id but not
the set of shingles are documents of their own; ids are read as longs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.llm import textbatch as tb
from daypulse.llm.spark_utils import components, join_skewed, passes, sieve, stored

#: Frequent tokens that are told to all tasks: a fixed number of 16-byte entries.
FREQUENT = 1 << 16
MIN_MATCHES, MAX_MATCHES = 3, 8
#: Cost of verifying a candidate, in list entries read.
VERIFY_COST = 4.0
#: Token lists up to this many entries are thinned by size; longer ones go on whole.
THINNED = 1 << 17
#: Entries of a token list that are compared at once; longer lists are compared block by block.
BLOCK = 2048
_NULL_ID = 1 << 62
_INFO = {"n": 24, "l": 20}


class Spec(NamedTuple):
    """Words a shingle, and the least similarity in percent."""

    size: int = 5
    percent: int = 80

    def least(self, n):
        """What a set of n must share with any other that it links with: ceil(t * n)."""
        return (self.percent * n + 99) // 100


def shingle_sets(data: np.ndarray, offs: np.ndarray, size: int):
    """Distinct shingle names of each text, sorted within it: (names, first of each text)."""
    data = tb.LOWER[data]
    w = tb.words(data, offs)
    roll = tb.Rolling(tb.word_hashes(data, w))
    count = np.diff(w.first)
    full = np.flatnonzero(tb.room_for(w.first, size))
    few = np.flatnonzero((count > 0) & (count < size))
    names = np.concatenate((roll(full, full + size), roll(w.first[few], w.first[few + 1])))
    text = np.concatenate((w.text[full], few))
    order = np.argsort(names)
    order = order[tb.stable_order(text[order])]
    names, text = names[order], text[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    names, text = names[new], text[new]
    return names, np.searchsorted(text, np.arange(len(offs)))


def _set_names(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (0x1B873593CC9E2D51, 0x85EBCA6BC2B2AE35):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tb.mix64(names ^ np.uint64(salt)), dtype=np.uint64)))
        out.append(tb.mix64(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)))
    return out[0], out[1]


def _ids(column: pa.Array, s: tb.Slice, name: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Ids that stand for one set each, where rows tell ids and sets apart.

    A null id is replaced by a large one made from the set's name, an id that several sets may share
    (it is in the bitmap ``shared``) by one made from itself and the set's name.
    """
    part = column.slice(s.first, len(s.offs) - 1)
    null = part.is_null().to_numpy(zero_copy_only=False)
    own = part.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    source = np.where(null, name, tb.mix64(name ^ tb.mix64(own.view(np.uint64))))
    made = np.int64(_NULL_ID) + (source >> np.uint64(3)).astype(np.int64)
    return np.where(null | passes(shared, own), made, own)


def _sets(plain: DataFrame, spec: Spec) -> DataFrame:
    def run(batches):
        for b in batches:
            for s in tb.slices(b.column(1)):
                names, first = shingle_sets(s.data, s.offs, spec.size)
                a, z = _set_names(names, first)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s.first, len(s.offs) - 1), pa.array(np.diff(first)), pa.array(tb.signed(a)),
                     pa.array(tb.signed(z))], names=["doc_id", "n", "s1", "s2"])

    return plain.mapInArrow(run, "doc_id long, n long, s1 long, s2 long")


def _shared_ids(sets: DataFrame):
    """A bitmap of the ids that rows with different sets share (few others pass)."""
    per = sets.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("s1").alias("a"), F.max("s1").alias("b"), F.min("s2").alias("c"), F.max("s2").alias("d"))
    return sieve(per.where("a <> b or c <> d"), "doc_id")


def _with_ids(sets: DataFrame, shared) -> DataFrame:
    def run(batches):
        for b in batches:
            n = b.num_rows
            did = _ids(b.column(0), tb.Slice(0, np.zeros(n + 1, np.int64), None), b.column(2).to_numpy().view(np.uint64), shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(did)], names=[*b.schema.names, "did"])

    return sets.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, did long")


def _frequent(plain: DataFrame, spec: Spec):
    """The tokens with the highest counts, by lossy counting over all documents.

    A task counts a token where it occurs in two texts of a slice or more; a token in more
    texts than there are slices cannot be missed. Only the order of tokens depends on it.
    """

    def run(batches):
        for b in batches:
            for s in tb.slices(b.column(1)):
                names, count = np.unique(shingle_sets(s.data, s.offs, spec.size)[0], return_counts=True)
                many = count > 1
                yield pa.RecordBatch.from_arrays([pa.array(tb.signed(names[many])), pa.array(count[many])],
                                                 names=["token", "c"])

    top = (plain.mapInArrow(run, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
           .orderBy(F.desc("c"), "token").limit(FREQUENT).toArrow())
    token = top["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    return plain.sparkSession.sparkContext.broadcast((token[order], top["c"].to_numpy()[order]))


def choose_prefixes(names: np.ndarray, first: np.ndarray, frequent, spec: Spec) -> tuple:
    """Tokens of each set's prefix, with (l, own): the matches it asks for and its infrequent tokens."""
    token, count = frequent
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    est = np.zeros(len(names), np.int64)
    if len(token):
        at = np.minimum(np.searchsorted(token, names), len(token) - 1)
        est = np.where(token[at] == names, count[at], 0)
    if est.any():
        order = np.lexsort((est, text))  # stable: by name where counts tie
        names, est = names[order], est[order]
    n = np.diff(first)
    reads = np.concatenate(([0], np.cumsum(est)))
    best, cost = np.ones(len(n), np.int64), np.full(len(n), np.inf)
    least = np.minimum(MIN_MATCHES, spec.least(n))
    for matches in range(1, MAX_MATCHES + 1):
        length = n - spec.least(n) + matches
        read = reads[first[:-1] + np.minimum(length, n)] - reads[first[:-1]]
        now = np.where((length <= n) & (matches >= least), read + VERIFY_COST * read / matches, np.inf)
        better = now < cost
        best, cost = np.where(better, matches, best), np.where(better, now, cost)
    length = np.where(n > 0, n - spec.least(n) + best, 0)
    seen = np.concatenate(([0], np.cumsum(est == 0)))
    own = seen[first[1:]] - seen[first[:-1]]
    start = np.repeat(first[:-1], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return names[start], length, best, own


def _prefixes(plain: DataFrame, frequent, copied, shared, spec: Spec) -> DataFrame:
    """Per document (did, info, tokens, maybe): ``maybe`` if its set may have copies."""

    def run(batches):
        for b in batches:
            for s in tb.slices(b.column(1)):
                names, first = shingle_sets(s.data, s.offs, spec.size)
                a, _ = _set_names(names, first)
                tokens, length, matches, own = choose_prefixes(names, first, frequent.value, spec)
                info = (np.diff(first) << _INFO["n"]) | (matches << _INFO["l"]) | np.minimum(own, (1 << 20) - 1)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(length))).astype(np.int32)),
                                                 pa.array(tb.signed(tokens)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_ids(b.column(0), s, a, shared.value)), pa.array(info), lists, pa.array(passes(copied.value, tb.signed(a)))],
                    names=["did", "info", "tokens", "maybe"])

    return plain.mapInArrow(run, "did long, info long, tokens array<long>, maybe boolean")


def _shared_entries(entries: DataFrame) -> DataFrame:
    """The entries (token, did, info, pos) of tokens with two documents or more."""

    def run(batches):
        held = None
        before = None  # the token before the held row
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.RecordBatch.from_struct_array(pa.concat_arrays([held.to_struct_array(), b.to_struct_array()]))
            t = b.column(0).to_numpy()
            same = t[1:] == t[:-1]
            ok = np.zeros(len(t), bool)
            ok[1:] |= same
            ok[:-1] |= same
            ok[0] |= before is not None and before == t[0]
            held, before = b.slice(len(t) - 1), (t[-2] if len(t) > 1 else before)
            yield b.slice(0, len(t) - 1).filter(pa.array(ok[:-1]))
        if held is not None and before == held.column(0)[0].as_py():
            yield held

    dealt = entries.repartition("token").sortWithinPartitions("token")
    return dealt.mapInArrow(run, "token long, did long, info long, pos int")


def _n(info):
    return F.shiftright(info, _INFO["n"])


def _enough(pairs: DataFrame, spec: Spec) -> DataFrame:
    """Pairs (a, b) with the matches that their prefixes and sizes ask for; from (a, ia, b, ib), one row a match."""
    per = pairs.groupBy("a", "b").agg(F.count("*").alias("c"), F.min("ia").alias("ia"), F.min("ib").alias("ib"))
    na, nb = _n(F.col("ia")), _n(F.col("ib"))
    least = lambda n: F.expr(f"({spec.percent} * {n} + 99) div 100")
    per = per.select("a", "b", "c", na.alias("na"), nb.alias("nb"),
                     F.shiftright("ia", _INFO["l"]).bitwiseAND(F.lit(15)).alias("la"),
                     F.shiftright("ib", _INFO["l"]).bitwiseAND(F.lit(15)).alias("lb"))
    # of i >= t (na + nb - i): i >= t / (1 + t) (na + nb); beyond a prefix lie ceil(t n) - l tokens
    both = 100 + spec.percent
    need = F.expr(f"({spec.percent} * (na + nb) + {both - 1}) div {both}") - F.greatest(least("na") - F.col("la"), least("nb") - F.col("lb"))
    return per.where((F.col("c") >= F.least("la", "lb")) & (F.col("c") >= need)).select("a", "b")


def _verified(pairs: DataFrame, plain: DataFrame, shared, spec: Spec, label: str) -> DataFrame:
    """The pairs whose similarity is high enough, from the whole shingle sets of both documents."""
    pairs = stored(pairs, f"{label}-candidates")
    wanted = sieve(pairs.select(F.explode(F.array("a", "b")).alias("x")), "x")

    def sets(batches):
        for b in batches:
            # an id that is made from the text is only known further down
            own = b.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            maybe = passes(wanted.value, own) | passes(shared.value, own) | b.column(0).is_null().to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(maybe))
            for s in tb.slices(b.column(1)):
                names, first = shingle_sets(s.data, s.offs, spec.size)
                a, _ = _set_names(names, first)
                body = names.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_ids(b.column(0), s, a, shared.value)),
                     pa.array([body[8 * i:8 * j] for i, j in zip(first[:-1], first[1:])], pa.binary())],
                    names=["did", "body"])

    def verify(batches):
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= spec.percent * (len(x) + len(y) - both)
            yield b.select(["a", "b"]).filter(pa.array(keep))

    bodies = plain.mapInArrow(sets, "did long, body binary")
    near = pairs.join(bodies.select(F.col("did").alias("b"), F.col("body").alias("y")), "b")
    near = near.join(bodies.select(F.col("did").alias("a"), F.col("body").alias("x")), "a")
    return stored(near.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"), f"{label}-links")


def _star_pairs(entries: DataFrame, spec: Spec) -> DataFrame:
    """Every entry with its list's pivot of the same size band."""
    band = F.floor(F.log(_n(F.col("info")).cast("double")) / np.log(100 / spec.percent)).cast("int")
    own = F.col("info").bitwiseAND(F.lit((1 << 20) - 1))
    rows = entries.withColumn("band", band)
    # fewest tokens of its own, then least id; all in one number pair, combined map-side
    pivots = rows.groupBy("token", "band").agg(
        F.min(F.struct(own.alias("o"), "did", "info")).alias("p"), F.count("*").alias("m")).where("m > 1")
    return rows.join(pivots, ["token", "band"]).where("did <> p.did").select(
        F.col("p.did").alias("a"), F.col("p.info").alias("ia"), F.col("did").alias("b"), F.col("info").alias("ib"))


def _cross_pairs(entries: DataFrame, roots: DataFrame, spec: Spec) -> DataFrame:
    """Pairs (a, b) from different components with the matches that their prefixes and sizes ask for.

    Entries without an entry of another component and a fitting size in their list are left
    out, and then documents with too few entries. Of the others each document sends its
    tokens along, so matches are counted where the list is read and a
    pair is only looked at in the list of its first common token. Long lists are cut into
    blocks of about BLOCK entries; every pair of blocks is a unit of work of its own.
    """
    rows = entries.join(roots, F.col("did") == F.col("node"), "left").select(
        "token", "info", "did", "pos", F.coalesce("root", "did").alias("root"))
    rows = stored(rows.repartition("token").sortWithinPartitions("token", "info").mapInArrow(
        lambda batches: _thinned(batches, spec), T.StructType([*rows.schema.fields, T.StructField("head", T.BooleanType())])),
        "jaccard-mixed")
    # with the number of its entries left, a document fits fewer sizes
    left = rows.groupBy("did", "info", "root").agg(F.collect_list(F.struct("token", "pos", "head")).alias("all"))
    left = left.select("did", "info", "root", F.size("all").alias("k"), F.inline("all")).select(
        "token", "info", "did", "pos", "root", "head", "k")
    rows = stored(left.repartition("token").sortWithinPartitions("token", "info").mapInArrow(
        lambda batches: _in_lists(batches, lambda b: _reachable(b, spec), lambda b: b), left.schema), "jaccard-reachable").drop("k")
    long = rows.groupBy("token").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK) \
        .select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("parts"))
    rows = rows.join(long, "token", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    per_doc = rows.groupBy("did", "info", "root").agg(
        F.array_sort(F.collect_list(F.struct("pos", "token", "parts", "head"))).alias("all"))
    # sets of five and more only link with sets that ask for MIN_MATCHES too
    per_doc = per_doc.where((F.size("all") >= MIN_MATCHES) | (_n(F.col("info")) < 5))
    # tokens before the list's own tell whether a pair belongs to an earlier list, so they go whole;
    # those from it on are only counted: four bytes of each can count a match too many, never too few
    sent = per_doc.select("did", "info", "root", F.col("all.token").alias("mine"), F.posexplode("all").alias("at", "x"))
    sent = sent.where("x.head").select("did", "info", "root", "x", F.slice("mine", F.lit(1), F.col("at")).alias("early"),
                                       F.transform(F.slice("mine", F.col("at") + 1, F.size("mine")), lambda t: (
                                           t.bitwiseAND(F.lit(0x7FFFFFFF))).cast("int")).alias("rest"))
    part = F.pmod(F.xxhash64("did"), F.col("x.parts")).cast("int")
    sent = sent.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("x.parts") - 1)))
    sent = sent.select(F.col("x.token").alias("token"), F.least("part", "other").alias("p"),
                       F.greatest("part", "other").alias("q"), "part", "did", "info", "root", "early", "rest")

    def run(batches):
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)])
            cut = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
            if held and any(held[-1].column(i)[-1].as_py() != k[i, 0] for i in range(3)):
                cut = np.concatenate(([0], cut))
            at = 0
            for c in cut:  # work is done on whole lists, a few thousand entries at once
                if size + c - at >= BLOCK:
                    yield from _pairs_of([*held, b.slice(at, c - at)], spec)
                    held, size, at = [], 0, c
            held.append(b.slice(at))
            size += b.num_rows - at
        if held:
            yield from _pairs_of(held, spec)

    dealt = sent.repartition("token", "p", "q").sortWithinPartitions("token", "p", "q")
    return dealt.mapInArrow(run, "a long, b long")


def _thinned(batches, spec: Spec):
    """Of entries in order of (token, size): those whose list has one of another root within their sizes.

    ``head`` tells if the token may be the first that the two have in common: from its
    position on there must be enough tokens left for the overlap that their sizes ask for.
    """
    def thin(b: pa.RecordBatch) -> pa.RecordBatch:
        token, info, root = (b.column(i).to_numpy() for i in (0, 1, 4))
        n = info >> _INFO["n"]
        same = token[1:] == token[:-1]
        group = np.concatenate(([0], np.cumsum(~same)))
        wide = int(n.max()) * 2 + 2
        place = group * wide + n
        lo = np.searchsorted(place, group * wide + spec.least(n), side="left")
        hi = np.searchsorted(place, group * wide + np.minimum(n * 100 // spec.percent, wide - 1), side="right")
        change = np.concatenate(([0], np.cumsum(~same | (root[1:] != root[:-1]))))
        ok = change[hi - 1] > change[lo]
        # first in common at pos: percent * (n + m) <= (100 + percent) * (n - pos)
        most = (100 + spec.percent) * (n - b.column(3).to_numpy()) // spec.percent - n
        end = np.searchsorted(place, group * wide + np.clip(np.minimum(most, n * 100 // spec.percent), 0, wide - 1), side="right")
        head = (end > lo) & ((change[np.maximum(end, 1) - 1] > change[lo]) | (root[lo] != root))
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(head)], names=[*b.schema.names, "head"]).filter(pa.array(ok))

    def uncut(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(np.ones(b.num_rows, bool))], names=[*b.schema.names, "head"])

    yield from _in_lists(batches, thin, uncut)


def _reachable(b: pa.RecordBatch, spec: Spec) -> pa.RecordBatch:
    """Of entries with k, the entries that their document has left: those that may reach enough matches.

    Of a pair of sizes n <= m with the longer's prefix ending last, matches must reach
    ``t (n + m) / (1 + t) - t m + l``; with k entries that leaves two ranges of partner sizes.
    """
    token, info, root, k = (b.column(i).to_numpy().astype(np.int64) for i in (0, 1, 4, 6))
    n, t = info >> _INFO["n"], spec.percent
    same = token[1:] == token[:-1]
    group = np.concatenate(([0], np.cumsum(~same)))
    wide = int(n.max()) * 2 + 2
    place = group * wide + n
    change = np.concatenate(([0], np.cumsum(~same | (root[1:] != root[:-1]))))
    # k >= t (n + m) / (1 + t) - t max(n, m) (the matches asked for only add to it; 2 for roundings)
    slack = (k + 2) * (100 + t) * 100
    ok = np.zeros(len(n), bool)
    most = n * 100 // t
    for low, high in ((spec.least(n), np.minimum(n, (slack // t + t * n) // 100 + 1)),
                      (np.maximum(n, (n * 100 - slack // t) // t - 1), most)):
        lo = np.searchsorted(place, group * wide + np.clip(low, 0, wide - 1), side="left")
        hi = np.searchsorted(place, group * wide + np.clip(high, 0, wide - 1), side="right")
        ok |= (hi > lo) & ((change[np.maximum(hi, 1) - 1] > change[np.minimum(lo, len(n) - 1)])
                           | (root[np.minimum(lo, len(n) - 1)] != root))
    return b.filter(pa.array(ok))


def _in_lists(batches, thin, uncut):
    """``thin`` on whole token lists, ``uncut`` on the parts of lists longer than THINNED."""
    held, size, whole = [], 0, None
    for b in batches:
        if whole is not None and b.num_rows:
            more = int(np.searchsorted(b.column(0).to_numpy(), whole, side="right"))
            yield uncut(b.slice(0, more))
            b = b.slice(more)
        if not b.num_rows:
            continue
        token = b.column(0).to_numpy()
        whole = None
        last = int(np.searchsorted(token, token[-1], side="left"))  # the last list may go on
        if held and held[-1].column(0)[-1].as_py() != token[0] or last > 0:
            head = [*held, b.slice(0, last)] if last > 0 else held
            if head:
                yield from map(thin, _joined(head))
            held, size = [], 0
        held.append(b.slice(last))
        size += b.num_rows - last
        if size > THINNED:  # a list of this length goes on whole
            yield from map(uncut, held)
            held, size, whole = [], 0, token[-1]
    if held:
        yield from map(thin, _joined(held))


def _joined(parts: list) -> list:
    parts = [x for x in parts if x.num_rows]
    return [pa.RecordBatch.from_struct_array(pa.concat_arrays([x.to_struct_array() for x in parts]))] if parts else []


def _pairs_of(held: list, spec: Spec):
    """The pairs wanted of the complete (token, p, q) groups in ``held``."""
    t = pa.Table.from_batches(held)
    token, p, q, part, did, info, root = (t.column(i).to_numpy() for i in range(7))

    def lists(i: int) -> tuple[np.ndarray, np.ndarray]:
        whole = t.column(i).combine_chunks()
        whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
        first = whole.offsets.to_numpy().astype(np.int64)
        return whole.flatten().to_numpy(), first - first[0]

    early, rest = lists(7), lists(8)
    n, matches = info >> _INFO["n"], (info >> _INFO["l"]) & 15
    beyond = spec.least(n) - matches  # tokens after the prefix, at most
    begin = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1]))))
    for lo, hi in zip(begin, np.append(begin[1:], len(token))):
        if hi - lo < 2:
            continue
        rows, m = np.arange(lo, hi), hi - lo
        coded = []  # (entry, token number, tokens) of the early and of the other tokens
        for flat, first in (early, rest):
            span = first[lo:hi + 1]
            name, code = np.unique(flat[span[0]:span[-1]], return_inverse=True)
            coded.append((np.repeat(rows - lo, np.diff(span)), code, len(name)))
        todo = np.arange(m)
        if len(coded[0][0]):
            # documents that share an earlier token meet in its list: none of their pairs is wanted here
            has = np.zeros(m, bool)
            has[coded[0][0][coded[0][1] == np.bincount(coded[0][1]).argmax()]] = True
            todo = np.flatnonzero(~has)
        for c in range(0, len(todo), 128):
            mine = todo[c:c + 128]
            before, both = np.zeros((len(mine), m), np.float32), np.zeros((len(mine), m), np.float32)
            for out, (own, code, width) in zip((before, both), coded):
                for w in range(0, width, 1024):
                    some = (code >= w) & (code < w + 1024)
                    grid = np.zeros((m, min(1024, width - w)), np.float32)
                    # two tokens of one document with equal short codes count twice
                    np.add.at(grid.reshape(-1), own[some] * grid.shape[1] + code[some] - w, 1)
                    out += grid[mine] @ grid.T
            x, y = lo + mine[:, None], rows[None, :]
            total = n[x] + n[y]
            need = np.maximum(-(-spec.percent * total // (100 + spec.percent)) - np.maximum(beyond[x], beyond[y]),
                              np.minimum(matches[x], matches[y]))
            ok = (both >= need) & (before == 0) & (root[x] != root[y]) & (did[x] != did[y])
            ok &= 100 * np.minimum(n[x], n[y]) >= spec.percent * np.maximum(n[x], n[y])
            ok &= (p[lo] == q[lo]) | (part[x] != part[y])  # each pair in one pair of blocks only
            later = np.zeros(m, bool)
            later[todo] = True  # a pair of two that are to do is taken once
            ok &= ~later[None, :] | (mine[:, None] < np.arange(m)[None, :])
            i, j = np.nonzero(ok)
            i, j = did[lo + mine[i]], did[lo + j]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j))], names=["a", "b"])


def _near_groups(docs: DataFrame, doc_id: str, text: str, spec: Spec):
    """The rows of ``near_groups`` and the bitmap of shared ids."""
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = stored(_sets(plain, spec), "jaccard-names")
    shared = _shared_ids(sets)
    sets = stored(_with_ids(sets, shared), "jaccard-sets")
    classes = sets.where("n > 0").groupBy("s1", "s2").agg(F.min("did").alias("rep"), F.count("*").alias("m"))
    classes = stored(classes.where("m > 1"), "jaccard-classes")
    copies = stored(sets.join(classes, ["s1", "s2"]).where("did <> rep").select("did", "rep").distinct(), "jaccard-copies")

    prefixes = _prefixes(plain, _frequent(plain, spec), sieve(classes, "s1"), shared, spec)
    prefixes = stored(prefixes, "jaccard-prefixes")
    maybe = prefixes.where("maybe").join(copies, "did", "left_anti").dropDuplicates(["did"])
    entries = prefixes.where("not maybe").unionByName(maybe).select("did", "info", F.posexplode("tokens").alias("pos", "token"))
    entries = stored(_shared_entries(entries.select("token", "did", "info", "pos")), "jaccard-entries")

    near = _verified(_enough(_star_pairs(entries, spec), spec), plain, shared, spec, "jaccard-star")
    roots = components(near, name="jaccard-first")
    far = _verified(_cross_pairs(entries, roots, spec).distinct(), plain, shared, spec, "jaccard-cross")
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(far),
                       name="jaccard-roots")

    rows = sets.join(copies, "did", "left").withColumn("rep", F.coalesce("rep", "did"))
    rows = rows.join(roots, F.col("rep") == F.col("node"), "left")
    rows = rows.select("doc_id", "did", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("root"))
    if sets.where(F.col("did") >= _NULL_ID).where("doc_id is not null").isEmpty():
        return rows.withColumn("component_id", F.when(F.col("root") < _NULL_ID, F.col("root"))), shared
    # made ids are not in the order of the ids that they stand for: name each group by its least doc_id
    rows = stored(rows, "jaccard-groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "did"))
    named = rows.groupBy(F.col("root").alias("__root")).agg(first.alias("f")).select(
        "__root", F.col("f.doc_id").alias("component_id"), F.col("f.did").alias("__first"))
    rows = join_skewed(rows, named, "root", "__root")
    return rows.select("doc_id", "did", "n_shingles", F.col("__first").alias("root"), "component_id"), shared


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spec: Spec = Spec()) -> DataFrame:
    """Per row of ``docs``: doc_id, did (one id per doc_id and set), n_shingles, component_id and root.

    ``component_id`` is the least doc_id reachable by links, ``root`` the did of one such row.
    """
    return _near_groups(docs, doc_id, text, spec)[0]


def join_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spec: Spec = Spec()) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id."""
    found = near_groups(docs, doc_id, text, spec)
    return found.select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", spec: Spec = Spec()) -> DataFrame:
    """One document of each group, the one that names it, with its own columns; texts without words stay."""
    found, shared = _near_groups(docs, doc_id, text, spec)
    state = found.groupBy("did").agg(F.max((F.col("did") != F.col("root")).cast("int")).alias("gone"),
                                     F.max(F.col("n_shingles")).alias("n"), F.count("*").alias("m"))
    touched = stored(state.where("gone = 1 or (m > 1 and n > 0)"), "jaccard-touched")
    wanted = sieve(touched, "did")
    names = [f.name for f in docs.schema.fields]
    id_at, text_at = names.index(doc_id), names.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("__j_did", T.LongType()), T.StructField("__j_hit", T.BooleanType())])

    def run(batches):
        for b in batches:
            ids = b.column(id_at).cast(pa.int64())
            for s in tb.slices(b.column(text_at)):
                a, _ = _set_names(*shingle_sets(s.data, s.offs, spec.size))
                did = _ids(ids, s, a, shared.value)
                part = b.slice(s.first, len(s.offs) - 1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(did), pa.array(passes(wanted.value, did))],
                                                 names=[*names, "__j_did", "__j_hit"])

    marked = docs.mapInArrow(run, schema)
    hit = marked.where("__j_hit").join(touched.select(F.col("did").alias("__j_did"), "gone", "m"), "__j_did", "left")
    hit = hit.where("gone is null or gone = 0")
    once = hit.where("m > 1").dropDuplicates(["__j_did"])
    cols = [F.col(f"`{c}`") for c in names]
    return (marked.where("not __j_hit").select(*cols)
            .unionByName(hit.where("m is null or m = 1").select(*cols)).unionByName(once.select(*cols)))
