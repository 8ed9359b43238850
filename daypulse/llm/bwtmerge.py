"""Substring deduplication of byte windows by merging Burrows-Wheeler transforms.

Windows are dealt out by their anchor, the least q-gram name in the window (a minimiser), so
equal windows meet in one partition and partitions need nothing of each other. There the
strings arrive in shards. A string is read as blocks of ``BLOCK`` bytes from each of its
offsets; a shard sorts its suffixes once and keeps its transform: for each suffix in order,
the block before it. Shard transforms are merged by iterative interleave refinement (Holt and
McMillan, 2014): reading the blocks in the order of the present interleave and sorting them
stably gives the interleave of one block more. Where a border between two neighbours first
appears, their common prefix in blocks is known; suffixes that no border of depth
``WINDOW / BLOCK`` separates form the repeated intervals. No suffix is sorted again in merging.

Defined results: null text is empty; texts under one window have no spans; repeated rows count as
other places, so they remove each other; overlapping occurrences in one text count. Equal blocks
are told by 64-bit content names inside one anchor's partition.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm import repeats as rp
from daypulse.llm import textbatch as tb

WINDOW = 200
QGRAM = 16
BLOCK = 50
#: Strings of a partition that are merged at once; block names then fit 16 bits, which sort in one pass.
MERGE_BYTES = 60_000
SHARD_BYTES = 1 << 14
#: Width of the classes of anchor offsets that a hot anchor is cut into.
OFFSETS = 25
_CHUNK = 1 << 20
_INDEX_BITS = 21


def cut_stretches(data: np.ndarray, offs: np.ndarray, window: int = WINDOW, q: int = QGRAM):
    valid = tb.room_for(offs, window)
    outs = []
    for c in range(0, len(data), _CHUNK):
        part = data[c:c + _CHUNK + window - 1]
        starts = np.flatnonzero(valid[c:c + _CHUNK])
        if not len(starts):
            continue
        roll = tb.Rolling(part)
        h = roll.each(q)
        packed = (h >> np.uint64(_INDEX_BITS) << np.uint64(_INDEX_BITS)) | np.arange(len(h), dtype=np.uint64)
        place = (tb.sliding_min(packed, window - q + 1)[starts] & np.uint64((1 << _INDEX_BITS) - 1)).astype(np.int64)
        fresh = np.ones(len(starts), bool)
        # windows of two texts are never neighbours: a text's last window starts before its end
        fresh[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(fresh)
        n = np.diff(np.append(first, len(starts)))
        s, p = starts[first], place[first]
        row = np.searchsorted(offs, c + s, side="right") - 1
        outs.append((h[p], tb.Rolling(part, 1)(s, s + n + window - 1), row, c + s - offs[row], n, p - s))
    if not outs:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*outs))


def _payload(data, offs, rows):
    """A stretch's bytes; of a hot anchor, cut by the anchor's offset in the window, under finer keys.

    Windows with the anchor at offsets ``c * OFFSETS .. (c + 1) * OFFSETS - 1`` share all bytes but
    OFFSETS - 1 at either end; that core names their group, so one common passage does not
    gather all texts that have it.
    """
    begin = offs[rows["text"]] + rows["start"]
    raw = data.tobytes()
    key = rows["key"].view(np.uint64)
    group, row, off, count, bodies = [], [], [], [], []
    roll = tb.Rolling(data)
    for i in range(len(begin)):
        b, n, at = int(begin[i]), int(rows["n"][i]), int(rows["at"][i])
        if not rows["hot"][i]:
            group.append(key[i]), row.append(i), off.append(0), count.append(n)
            bodies.append(raw[b:b + n + WINDOW - 1])
            continue
        for c in range(0, WINDOW // OFFSETS):
            # window j of the stretch has the anchor at offset at - j
            lo, hi = max(0, at - (c + 1) * OFFSETS + 1), min(n, at - c * OFFSETS + 1)
            if lo >= hi:
                continue
            core = b + at - c * OFFSETS
            end = b + at - (c + 1) * OFFSETS + 1 + WINDOW
            group.append(key[i] ^ tb.mix64(roll(np.array([core]), np.array([end])) + np.uint64(c))[0])
            row.append(i), off.append(lo), count.append(hi - lo)
            bodies.append(raw[b + lo:b + hi + WINDOW - 1])
    return np.array(group, np.uint64), row, off, count, bodies


def shard_transform(codes: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a shard in order of their block sequences, by prefix doubling up to ``depth`` blocks.

    ``codes[i]`` is the block at i, -1 where none fits (such suffixes come first); ``left[i]`` is
    the number of bytes to the string's end. Ties keep their place, as do the suffixes that
    follow them, so reading the blocks before the suffixes in this order is a true transform.
    """
    n = len(codes)
    rank = codes + 1
    step, reach = BLOCK, 1
    order = tb.stable_order(rank)
    while reach < depth:
        follows = np.zeros(n, np.int64)
        ok = np.flatnonzero(left >= step)
        follows[ok] = rank[ok + step]
        first = tb.stable_order(follows)
        order = first[tb.stable_order(rank[first])]
        r, x = rank[order], follows[order]
        fresh = np.zeros(n, np.int64)
        fresh[1:] = (r[1:] != r[:-1]) | (x[1:] != x[:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) + (r[0] > 0)
        step, reach = step * 2, reach * 2
    return order


def merge_transforms(codes: np.ndarray, left: np.ndarray, shard: np.ndarray, depth: int, full: int):
    """Merge the shards' transforms by ``depth`` refinements of their interleave.

    Returns the positions in merged order, the number of the interval (equal first ``depth``
    blocks) that each is in, and its common prefix, in blocks, with the one before it.
    """
    n = len(codes)
    begins = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
    ends = np.append(begins[1:], n)
    suffix = np.concatenate([a + shard_transform(codes[a:b], left[a:b], full) for a, b in zip(begins, ends)])
    # the transforms one after the other: the block before each suffix, -1 where there is none
    before = suffix - BLOCK
    symbol = np.where((before >= 0) & (codes[np.maximum(before, 0)] >= 0), codes[np.maximum(before, 0)], -1)
    of = shard[suffix]
    ending = of[codes[suffix] < 0]  # suffixes without a whole block come first, shard by shard
    inter = of  # an interleave says from which shard the next suffix comes
    interval = np.zeros(n, np.int64)
    prefix = np.full(n, depth, np.int64)
    for k in range(1, depth + 1):
        row = _rows(inter)
        live = symbol[row] >= 0
        sym, came, cls = symbol[row[live]], inter[live], interval[live]
        pick = tb.stable_order(sym)
        sym, cls = sym[pick], cls[pick]
        inter = np.concatenate((ending, came[pick]))
        border = np.zeros(n, bool)
        border[0] = True
        m = len(ending)
        border[m:m + 1] = True
        border[m + 1:] = (sym[1:] != sym[:-1]) | (cls[1:] != cls[:-1])
        prefix[border & (prefix == depth)] = k - 1
        interval = np.cumsum(border) - 1
    return suffix[_rows(inter)], interval, prefix


def _rows(inter: np.ndarray) -> np.ndarray:
    """For each entry of an interleave the row of the transforms it stands for: its shard's next one."""
    row = np.empty(len(inter), np.int64)
    row[tb.stable_order(inter)] = np.arange(len(inter))
    return row


def _repeated(group, did, w, off, n, data, offs):
    """For each string the runs of windows that lie in a repeated interval."""
    length = np.diff(offs)
    # one more place after each string: the empty suffix, where its chain of blocks ends
    owner = np.repeat(np.arange(len(n)), length + 1)
    begin = offs[:-1] + np.arange(len(n))
    total = len(owner)
    left = begin[owner] + length[owner] - np.arange(total)
    padded = np.zeros(total, np.uint8)
    padded[left > 0] = data
    i = np.flatnonzero(left >= BLOCK)
    codes = np.full(total, -1, np.int64)
    codes[i] = np.unique(tb.Rolling(padded)(i, i + BLOCK), return_inverse=True)[1]
    shard = (offs[:-1] // SHARD_BYTES)[owner]
    shard = np.cumsum(np.concatenate(([0], shard[1:] != shard[:-1])))
    order, interval, _ = merge_transforms(codes, left, shard, WINDOW // BLOCK, int(length.max()) // BLOCK + 1)
    # an interval's weight: the copies of all strings with a suffix in it
    weight = np.bincount(interval, weights=w[owner[order]])
    again = np.zeros(total, bool)
    again[order] = weight[interval] >= 2
    again &= left >= WINDOW
    edge = np.flatnonzero(np.diff(np.concatenate(([0], again.astype(np.int8), [0]))))
    s, e = edge[::2], edge[1::2]  # never across strings: a string's last places start no window
    row = owner[s] if len(s) else s
    return row, (s - begin[row] + off[row]).astype(np.int32), (e - begin[row] + off[row]).astype(np.int32)


def _finish(s, start, end, text):
    gone = tb.ranges_to_mask(start + s.offs[text], end + s.offs[text] + WINDOW - 1, len(s.data))
    total = np.concatenate(([0], np.cumsum(gone, dtype=np.int64)))
    removed = total[s.offs[1:]] - total[s.offs[:-1]]
    border = np.zeros(len(s.data) + 1, bool)
    border[s.offs] = True
    begins = gone.copy()
    begins[1:] &= ~gone[:-1] | border[1:-1]
    spans = np.concatenate(([0], np.cumsum(begins, dtype=np.int64)))
    kept = s.data[~gone].tobytes()
    at = s.offs - total[s.offs]
    digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]
    return np.diff(s.offs), removed, spans[s.offs[1:]] - spans[s.offs[:-1]], digests


def repeated_ranges(ident: DataFrame, label: str = "bytes") -> DataFrame:
    """(did, name, s, e): windows s .. e-1 of a text also start elsewhere."""
    found = rp.settled_and_open(ident, cut_stretches, [], F.col("c") >= 2, F.col("lo") == F.col("hi"), label)
    runs = rp.compared(ident, found, _payload, _repeated, "s int, e int", label, MERGE_BYTES)
    whole = found.where("whole").select("did", "name", "start", F.lit(0).alias("s"), F.col("n").alias("e"))
    rest = found.where("not whole").join(runs, ["key", "content"]).select("did", "name", "start", "s", "e")
    return whole.unionByName(rest).select("did", "name", (F.col("start") + F.col("s")).alias("s"),
                                          (F.col("start") + F.col("e")).alias("e"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and kept_sha256 of the bytes that stay."""
    ident = rp.identified(docs, doc_id, text)
    return rp.finished(ident, repeated_ranges(ident), _finish,
                       "n_bytes long, n_removed long, n_spans long, kept_sha256 string", "bytes")
