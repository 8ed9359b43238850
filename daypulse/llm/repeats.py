"""Windows that occur more than once: the Spark plan shared by the two substring deduplicators.

A *window* is a fixed number of consecutive items (words or bytes) of one text. Every window
gets an *anchor* that depends on its content only, so equal windows anywhere have equal
anchors; consecutive windows with the same anchor occurrence form a *stretch*. The plan:

1. count stretches per anchor (map-side combined: one row an anchor and task);
2. of anchors that may matter, list the stretches. Where all stretches of an anchor are one
   string, that settles all its windows;
3. otherwise one representative of each distinct stretch is cut from its text, sent to its
   anchor's partition and compared there window by window (the operator's own method);
4. the answers go back to all stretches, then to the texts.

Only stretches of shared anchors are shuffled, texts only where something in them is
compared or removed; fixed-size bitmaps thin both. A text is told apart by (doc_id, content),
so repeated rows are safe. Null ids sort after all others.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypulse.llm import textbatch as tb
from daypulse.llm.spark_utils import passes, sieve, stored

NO_ID = (1 << 63) - 1
#: Stretches of an anchor with more occurrences than this are compared under finer keys.
HOT = 4096
#: Payload compared at once in a task, cut between anchors.
CHUNK_BYTES = 1 << 18

_STRETCH = "key long, content long, did long, name long, start int, n int, at int"


def identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(did, text): integer ids, null last."""
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("did"), F.col(text).alias("text"))


def _names(s: tb.Slice) -> np.ndarray:
    """The content name of each text of a slice."""
    return tb.Rolling(s.data, 1)(s.offs[:-1], s.offs[1:])


def stretches(ident: DataFrame, cut: Callable) -> DataFrame:
    """All stretches of all texts."""

    def run(batches):
        for b in batches:
            ids = b.column(0).to_numpy()
            for s in tb.slices(b.column(1)):
                key, content, row, start, n, at = cut(s.data, s.offs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tb.signed(key)), pa.array(tb.signed(content)), pa.array(ids[s.first + row]),
                     pa.array(tb.signed(_names(s))[row]), pa.array(start.astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(at.astype(np.int32))],
                    names=["key", "content", "did", "name", "start", "n", "at"])

    return ident.mapInArrow(run, _STRETCH)


def _sifted(listed: DataFrame, shared) -> DataFrame:
    """The stretches whose anchor passes the sieve."""

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(passes(shared.value, b.column(0).to_numpy())))

    return listed.mapInArrow(run, _STRETCH)


def settled_and_open(ident: DataFrame, cut: Callable, summary: list[Column], shared: Column, whole: Column,
                     label: str) -> DataFrame:
    """Stretches of shared anchors with the anchor's summary, ``whole`` and ``hot``; stored.

    All stretches are cut once and stored (about 40 bytes each before compression), then counted and listed from there.
    """
    every = stored(stretches(ident, cut), f"{label}-every")
    per_key = (every.groupBy("key")
               .agg(F.count("*").alias("c"), F.min("content").alias("lo"), F.max("content").alias("hi"), *summary)
               .where(shared).withColumn("whole", whole).withColumn("hot", F.col("c") > HOT).drop("lo", "hi"))
    per_key = stored(per_key, f"{label}-anchors")
    listed = _sifted(every, sieve(per_key, "key"))
    return stored(listed.join(per_key, "key"), f"{label}-stretches")


def compared(ident: DataFrame, found: DataFrame, payload: Callable, compare: Callable, out: str,
             label: str, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Compare the distinct stretches of the open anchors, group by group.

    ``compare(groups, dids, weights, ns, payloads)`` gives for each the answers, columns ``out``.
    """
    dealt = cut_out(ident, found, payload, label).repartition("grp").sortWithinPartitions("grp")
    return dealt.mapInArrow(lambda batches: _compare(batches, compare, out, chunk), f"key long, content long, {out}")


def cut_out(ident: DataFrame, found: DataFrame, payload: Callable, label: str) -> DataFrame:
    """The distinct stretches of the open anchors, each from its document of least id: rows as ``payload`` cuts them.

    ``payload(data, texts, rows)`` gives (group, row, offset, n, bytes).
    """
    rep = F.min(F.struct("did", "name", "start", "n", "at"))
    open_ = (found.where("not whole").groupBy("key", "content", "hot").agg(F.count("*").alias("w"), rep.alias("r"))
             .select("key", "content", "hot", "w", "r.*"))
    per_text = stored(open_.groupBy("did", "name").agg(
        F.collect_list(F.struct("key", "content", "hot", "w", "start", "n", "at")).alias("cuts")), f"{label}-cuts")
    wanted = sieve(per_text, "did")
    texts = with_names(ident, wanted).join(per_text, ["did", "name"])
    return texts.select("did", "text", "cuts").mapInArrow(
        lambda batches: _send(batches, payload),
        "grp long, key long, content long, did long, w long, off int, n int, body binary")


def with_names(ident: DataFrame, wanted) -> DataFrame:
    """(did, name, text) of the texts whose id passes the sieve."""

    def run(batches):
        for b in batches:
            ok = passes(wanted.value, b.column(0).to_numpy())
            b = b.filter(pa.array(ok))
            for s in tb.slices(b.column(1)):
                part = b.slice(s.first, len(s.offs) - 1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tb.signed(_names(s))), part.column(1)],
                                                 names=["did", "name", "text"])

    return ident.mapInArrow(run, "did long, name long, text string")


def _send(batches, payload):
    for b in batches:
        ids = b.column(0).to_numpy()
        for s in tb.slices(b.column(1)):
            lists = b.column(2).slice(s.first, len(s.offs) - 1)
            flat = lists.flatten()
            count = np.diff(lists.offsets.to_numpy())
            rows = {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}
            rows["text"] = np.repeat(np.arange(len(count)), count)
            group, row, off, n, bodies = payload(s.data, s.offs, rows)
            row = np.asarray(row, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tb.signed(np.asarray(group, np.uint64))), pa.array(rows["key"][row]),
                 pa.array(rows["content"][row]), pa.array(ids[s.first + rows["text"][row]]), pa.array(rows["w"][row]),
                 pa.array(np.asarray(off, np.int32)), pa.array(np.asarray(n, np.int32)),
                 pa.array(bodies, pa.binary())],
                names=["grp", "key", "content", "did", "w", "off", "n", "body"])


def _compare(batches, compare, out, chunk):
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        group = b.column(0).to_numpy()
        length = np.diff(np.frombuffer(b.column(7).buffers()[1], np.int32)[b.column(7).offset:][:b.num_rows + 1])
        new = np.flatnonzero(np.concatenate(([bool(held) and held[-1].column(0)[-1].as_py() != group[0]],
                                             group[1:] != group[:-1])))
        at = 0
        total = np.concatenate(([0], np.cumsum(length)))
        for cut in new:
            if size + total[cut] - total[at] >= chunk:
                if cut > at:
                    held.append(b.slice(at, cut - at))
                yield from _answers(held, compare, out)
                held, size, at = [], 0, cut
        if at < b.num_rows:
            held.append(b.slice(at))
            size += total[-1] - total[at]
    if held:
        yield from _answers(held, compare, out)


def _answers(held, compare, out):
    t = pa.Table.from_batches(held).combine_chunks().to_batches()
    b = t[0] if len(t) == 1 else pa.RecordBatch.from_struct_array(pa.concat_arrays([x.to_struct_array() for x in t]))
    get = lambda i: b.column(i).to_numpy(zero_copy_only=False)
    body = b.column(7)
    offs = np.frombuffer(body.buffers()[1], np.int32)[body.offset:body.offset + len(body) + 1].astype(np.int64)
    data = np.frombuffer(body.buffers()[2], np.uint8)[offs[0]:offs[-1]]
    answers = compare(group=get(0), did=get(3), w=get(4), off=get(5).astype(np.int64), n=get(6).astype(np.int64),
                      data=data, offs=offs - offs[0])
    row = answers[0]
    yield pa.RecordBatch.from_arrays([pa.array(get(1)[row]), pa.array(get(2)[row]), *map(pa.array, answers[1:])],
                                     names=["key", "content", *[c.split()[0] for c in out.split(", ")]])


def finished(ident: DataFrame, ranges: DataFrame, finish: Callable, out: str, label: str) -> DataFrame:
    """``finish(slice, start, end, text)`` for all texts, with the ranges (did, name, s, e) of each.

    Texts with ranges are shuffled to them; all others are finished where they are read.
    """
    ranges = stored(ranges.groupBy("did", "name").agg(
        F.collect_list(F.struct("s", "e")).alias("ranges")), f"{label}-ranges")
    wanted = sieve(ranges, "did")

    def plain(batches):
        none = np.zeros(0, np.int64)
        for b in batches:
            b = b.filter(pa.array(~passes(wanted.value, b.column(0).to_numpy())))
            for s in tb.slices(b.column(1)):
                yield _row(b.column(0).slice(s.first, len(s.offs) - 1), finish(s, none, none, none))

    def cut(batches):
        for b in batches:
            for s in tb.slices(b.column(1)):
                lists = b.column(2).slice(s.first, len(s.offs) - 1).fill_null([])
                flat, count = lists.flatten(), np.diff(lists.offsets.to_numpy())
                start, end = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                text = np.repeat(np.arange(len(count)), count)
                yield _row(b.column(0).slice(s.first, len(s.offs) - 1), finish(s, start, end, text))

    def _row(ids, columns):
        return pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)],
                                          names=["did", *[c.split()[0] for c in out.split(", ")]])

    schema = f"did long, {out}"
    hit = with_names(ident, wanted).join(ranges, ["did", "name"], "left").select("did", "text", "ranges")
    both = ident.mapInArrow(plain, schema).unionByName(hit.mapInArrow(cut, schema))
    return both.withColumn("did", F.nullif("did", F.lit(NO_ID))).withColumnRenamed("did", "doc_id")
