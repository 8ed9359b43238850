"""Substring deduplication of word windows by recompression.

Rounds of recompression (Jez, 2013) name runs of one symbol and pairs of adjacent symbols. A
name is a 64-bit hash of what it stands for, so all tasks give equal runs and pairs the same
global name without exchanging a dictionary; a pair is formed where a left-class symbol meets a
right-class one, which depends on those two symbols only. Equal word sequences therefore get
equal symbols except near their ends. With every symbol the rounds track its *context*, the
words that its naming looked at: a symbol whose context lies inside a window is there in every
copy of that window. The longest such symbols (ties: least name) are the windows' anchors;
shared anchors reveal the repeats, and windows under them are compared by content to verify.
A window without such a symbol (inside one long run) is its own anchor.

Defined results: a window counts if it also starts in a document with a smaller doc_id; null
text has no words, a null doc_id is larger than all others, repeated rows of one doc_id are the
same document and do not remove each other. Names and comparisons are 64-bit content hashes,
a window being equal only if anchor name and window name both are (128 bits).
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm import repeats as rp
from daypulse.llm import textbatch as tb
from daypulse.llm.spark_utils import join_skewed, stored

WINDOW = 50
#: Symbols with a longer context are no anchors; a window looks at symbols in its first WINDOW - CONTEXT + 1 places.
CONTEXT = 22
#: Symbols of this many words or more are preferred as anchors.
LONG_SYMBOL = 4
ROUNDS = ("run", "pair", "pair", "run", "pair", "pair")
_FAR = 1 << 40
_INDEX_BITS = 21
_CHUNK = 1 << 20


def recompress(names: np.ndarray, text: np.ndarray, rounds=ROUNDS):
    """Symbols after the rounds: name, first and last+1 word, and the context (low, high)."""
    start = np.arange(len(names))
    end, low, high = start + 1, start.copy(), start + 1
    for number, kind in enumerate(rounds):
        if len(names) < 2:
            break
        with_next = text[1:] == text[:-1]
        if kind == "run":
            same = (names[1:] == names[:-1]) & with_next
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            last = np.append(first[1:], len(names)) - 1
            length = (last - first + 1).astype(np.uint64)
            left, right = _near(first - 1, low, text, text[first], -_FAR), _near(last + 1, high, text, text[first], _FAR)
            run_name = tb.mix64(names[first] ^ (length * np.uint64(0xD6E8FEB86659FD93)))
            names = np.where(length > 1, run_name, names[first])
            start, end, text = start[first], end[last], text[first]
            low, high = np.minimum(left, low[first]), np.maximum(right, high[last])
        else:
            is_left = tb.mix64(names + np.uint64(0xA0761D6478BD642F * (number + 1) % (1 << 64))) >> np.uint64(63) == 1
            here = is_left[:-1] & ~is_left[1:] & with_next
            opens, closes = np.append(here, False), np.insert(here, 0, False)
            at = np.arange(len(names))
            low = np.where(~opens & ~closes & ~is_left, np.minimum(low, _near(at - 1, low, text, text, -_FAR)), low)
            high = np.where(~opens & ~closes & is_left, np.maximum(high, _near(at + 1, high, text, text, _FAR)), high)
            one = np.flatnonzero(opens)
            names, end, high = names.copy(), end.copy(), high.copy()
            names[one] = tb.mix64(names[one] ^ tb.mix64(names[one + 1] + np.uint64(0xE7037ED1A0B428DB)))
            end[one], high[one] = end[one + 1], np.maximum(high[one], high[one + 1])
            low[one] = np.minimum(low[one], low[one + 1])
            stay = ~closes
            names, start, end, low, high, text = (x[stay] for x in (names, start, end, low, high, text))
    return names, start, end, low, high


def _near(at: np.ndarray, value: np.ndarray, text: np.ndarray, own: np.ndarray, beyond: int) -> np.ndarray:
    """The neighbour's bound, or ``beyond`` where the text ends: what is there is no part of a window."""
    ok = (at >= 0) & (at < len(value))
    safe = np.where(ok, at, 0)
    return np.where(ok & (text[safe] == own), value[safe], beyond)


def cut_stretches(data: np.ndarray, offs: np.ndarray, window: int = WINDOW, context: int = CONTEXT):
    w = tb.words(data, offs)
    h = tb.word_hashes(data, w)
    n = len(h)
    none = np.zeros(0, np.int64)
    if n < window:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none
    name, start, end, low, high = recompress(h, w.text)
    fit = (low >= 0) & (high - low <= context)
    name, low, span = name[fit], low[fit], (end - start)[fit]
    short = (span < LONG_SYMBOL).astype(np.uint64) << np.uint64(63)
    rank = short | (tb.mix64(name) >> np.uint64(1) >> np.uint64(_INDEX_BITS) << np.uint64(_INDEX_BITS))
    valid = tb.room_for(w.first, window)
    places = window - context + 1
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    best = np.full(n + places, -1, np.int64)  # for each window the place of its anchor
    for c in range(0, n, _CHUNK):
        grid = np.full(min(_CHUNK, n - c) + places, top, np.uint64)
        mine = (low >= c) & (low < c + len(grid))
        at = low[mine] - c
        np.minimum.at(grid, at, rank[mine] | at.astype(np.uint64))
        got = tb.sliding_min(grid, places)[:min(_CHUNK, n - c)]
        best[c:c + len(got)] = np.where(got == top, -1, (got & np.uint64((1 << _INDEX_BITS) - 1)).astype(np.int64) + c)
    # the name at a place: of symbols with one low bound the one that won there
    place_name = np.zeros(n, np.uint64)
    order = np.argsort(rank, kind="stable")[::-1]
    place_name[low[order]] = name[order]
    starts = np.flatnonzero(valid)
    place, text = best[starts], w.text[starts]
    roll = tb.Rolling(h, 1)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (place[1:] < 0) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(starts)))
    s, place = starts[first], place[first]
    key = np.where(place >= 0, place_name[np.maximum(place, 0)], roll(s, s + window))
    content = roll(s, s + count + window - 1)
    row = w.text[s]
    return key, content, row, s - w.first[row], count, np.maximum(place - s, 0)


def _payload(window: int):
    def cut(data, offs, rows):
        """The names of a stretch's windows; of a hot anchor each window goes by its own name."""
        w = tb.words(data, offs)
        roll = tb.Rolling(tb.word_hashes(data, w), 1)
        begin = w.first[rows["text"]] + rows["start"]
        n = rows["n"].astype(np.int64)
        skip = np.repeat(np.cumsum(n) - n, n)
        off = np.arange(n.sum()) - skip
        at = np.repeat(begin, n) + off
        names = roll(at, at + window)
        row = np.repeat(np.arange(len(n)), n)
        hot = rows["hot"].astype(bool)
        bounds = np.concatenate(([0], np.cumsum(n)))
        cool = np.flatnonzero(~hot)
        bodies = [names[bounds[i]:bounds[i + 1]].tobytes() for i in cool]
        group = [rows["key"][cool].astype(np.int64).view(np.uint64)]
        single = np.flatnonzero(hot[row])
        group.append(names[single] ^ rows["key"][row[single]].view(np.uint64))
        bodies += [names[i].tobytes() for i in single]
        return (np.concatenate(group), np.concatenate((cool, row[single])),
                np.concatenate((np.zeros(len(cool), np.int64), off[single])),
                np.concatenate((n[cool], np.ones(len(single), np.int64))), bodies)

    return cut


def _least_document(group, did, w, off, n, data, offs):
    """For each stretch runs of windows with the least document that has them."""
    names = np.frombuffer(data.tobytes(), np.uint64)
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    order = np.lexsort((did[row], names, group[row]))
    g, x = group[row][order], names[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (g[1:] != g[:-1]) | (x[1:] != x[:-1])
    least = np.empty(len(order), np.int64)
    least[order] = did[row][order][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    cut = np.ones(len(row), bool)
    cut[1:] = (row[1:] != row[:-1]) | (least[1:] != least[:-1])
    first = np.flatnonzero(cut)
    length = np.diff(np.append(first, len(row)))
    r = row[first]
    s = off[r] + place[first]
    return r, s.astype(np.int32), (s + length).astype(np.int32), least[first]


def _least_of_hot(ident: DataFrame, found: DataFrame, window: int, label: str) -> DataFrame:
    """The least document of each window of hot anchors that several have, as (key, content, s, e, m).

    Windows go by their own names and are counted with partial aggregates, so one that is in every
    document costs a task one row; the few most frequent ones are broadcast on the way back.
    """
    rows = rp.cut_out(ident, found, _payload(window), f"{label}-hot")
    rows = stored(rows.select("key", "content", "did", "w", F.col("off").alias("s"), F.concat_ws(
        ":", "key", F.hex("body")).alias("name")), f"{label}-hot-windows")
    least = rows.groupBy(F.col("name").alias("window")).agg(F.min("did").alias("m"), F.sum("w").alias("c"))
    hits = join_skewed(rows, least.where("c > 1").drop("c"), "name", "window")
    return hits.select("key", "content", "s", (F.col("s") + 1).cast("int").alias("e"), "m")


def _finish(window: int):
    def finish(s, start, end, text):
        w = tb.words(s.data, s.offs)
        n = len(w.start)
        gone = tb.ranges_to_mask(start + w.first[text], end + w.first[text] + window - 1, n)
        total = np.diff(w.first)
        removed = np.bincount(w.text[gone], minlength=len(total))
        kept = np.flatnonzero(~gone)
        last = np.ones(len(kept), bool)
        last[:-1] = w.text[kept[1:]] != w.text[kept[:-1]]
        step = np.zeros(len(s.data) + 2, np.int64)
        np.add.at(step, w.start[kept], 1)
        np.add.at(step, w.end[kept] + ~last, -1)  # with the one byte after a word, but not after the last
        mask = np.cumsum(step[:len(s.data)]) > 0
        clean = np.where(tb.NON_SPACE[s.data], s.data, 0x20).astype(np.uint8)[mask].tobytes()
        bounds = np.concatenate(([0], np.cumsum(mask)))[s.offs]
        digests = [hashlib.sha256(clean[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
        return total.astype(np.int64), removed.astype(np.int64), digests

    return finish


def repeated_ranges(ident: DataFrame, window: int = WINDOW, label: str = "words") -> DataFrame:
    """(did, name, s, e): windows s .. e-1 of a text also start in a document with a smaller id."""
    found = rp.settled_and_open(
        ident, cut_stretches, [F.min("did").alias("least"), F.max("did").alias("most")],
        F.col("least") < F.col("most"), F.col("lo") == F.col("hi"), label)
    cool = rp.compared(ident, found.where("not hot"), _payload(window), _least_document, "s int, e int, m long", label)
    runs = cool.unionByName(_least_of_hot(ident, found.where("hot"), window, label))
    whole = found.where("whole and did > least").select("did", "name", "start", F.lit(0).alias("s"), F.col("n").alias("e"))
    rest = (found.where("not whole").join(runs, ["key", "content"]).where("did > m")
            .select("did", "name", "start", "s", "e"))
    return whole.unionByName(rest).select("did", "name", (F.col("start") + F.col("s")).alias("s"),
                                          (F.col("start") + F.col("e")).alias("e"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed and kept_sha256 of the words that stay."""
    ident = rp.identified(docs, doc_id, text)
    return rp.finished(ident, repeated_ranges(ident), _finish(WINDOW),
                       "n_words long, n_removed long, kept_sha256 string", "words")
