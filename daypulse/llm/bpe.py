"""Byte-level BPE encoding and decoding, with tree concatenation for long texts.

A text of at most ``LEAF`` code points is encoded where it is read. A longer one is cut in halves,
and those again, down to leaves. Spark deals them out in runs of ``FAN_IN`` neighbours; the task that
gets a run encodes its leaves and joins them, and a tree of rounds joins the runs of a text. Two
encodings meet like this:

* The pieces (pre-tokens) around the cut are scanned again from the last one that the cut cannot have
  changed, over a window of the right side that grows until a border of the new scan is a border of
  the right side's own scan. From there on both scans agree, as a scan depends on nothing before it.
* A piece that the cut went through keeps the tokens of its two parts, but for a window around the
  join that is encoded again and grows until its first and last token are those that the two parts
  have there. An encoding whose neighbouring tokens all encode to themselves is the encoding of the
  whole, so both sides then agree exactly. A single piece of more than ``PIECE`` bytes is encoded in
  halves by the same rule, inside a task.

Each text is shuffled once, as runs of leaves. From then on only ids and the flags "begins a piece"
travel: the text is what the ids decode to. Where digests are wanted, they take the place of the ids in
the round that completes a text, so ids are written only for texts that have further rounds before them.

The vocabulary is a ``tokenizers`` file of a byte-level BPE without normaliser; its path is a
parameter, its content is read once and broadcast (a few MB, whatever the corpus). Results are those
of ``encode(text, add_special_tokens=False)`` with truncation and padding off: strings of added tokens
in a text count as these tokens. A text with a code point that is unassigned for this Python (newer
letters than the library's tables may know) is cut into pieces by the library itself.

Defined results: a null text counts as empty and has no ids; equal long texts are encoded once;
repeated rows give repeated rows; an empty table gives an empty table; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daypulse.llm.spark_utils import join_skewed, stored

#: Code points up to which a text is encoded in one go.
LEAF = 8192
#: Bytes up to which a single piece is encoded in one go.
PIECE = 4096
#: Neighbouring leaves or segments that one task joins in a round.
FAN_IN = 16
#: Runs that a task turns into Python strings at a time.
RUNS = 64
#: Bytes at the end of a part in which another ending could move a border (four times 16 code points).
MARGIN = 64
#: Pieces of one generation that a worker remembers; it holds two.
REMEMBERED = 1 << 18

#: Fixed value: the split of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for ASCII texts, spelled out for ``re``, which takes less time.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"


def byte_letters() -> list[str]:
    """The printable stand-in for each byte: visible Latin-1 characters stand for themselves."""
    shown = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def _unassigned() -> np.ndarray:
    """True for each code point without a category here."""
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)), bool, 0x110000)


#: Ids as they are held and sent: vocabularies of up to 65,536 tokens fit two bytes.
ID = np.dtype(np.uint16)


@dataclass
class Segment:
    """Ids of a stretch of text and, for each, whether it begins a piece."""

    ids: np.ndarray
    first: np.ndarray


class Coder:
    """A vocabulary in use: pieces, tokens of pieces, joins."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given this task its core
        from tokenizers import Tokenizer

        spec = json.loads(content)
        if spec["normalizer"] is not None or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" \
                or spec["pre_tokenizer"]["add_prefix_space"] or not spec["pre_tokenizer"]["use_regex"] \
                or spec["model"]["type"] != "BPE" or spec["model"].get("dropout") or spec["model"].get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE")
        added = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"])
               or len(t["content"]) > MARGIN // 4 for t in spec["added_tokens"]):
            raise ValueError("added tokens must match plainly")
        letters = byte_letters()
        value = {c: b for b, c in enumerate(letters)}
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        if size > 1 << 8 * ID.itemsize:
            raise ValueError("too many tokens for two-byte ids")
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self.shown = [str(i) for i in range(size)]
        self.letters = letters
        self._table = str.maketrans({chr(b): c for b, c in enumerate(letters)})
        self._library = Tokenizer.from_str(content)
        raw = spec | {"pre_tokenizer": None, "decoder": None, "added_tokens": [], "truncation": None, "padding": None}
        self._model = Tokenizer.from_str(json.dumps(raw)).model
        self._split = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self._pattern = regex.compile(PATTERN)
        self._ascii_pattern = re.compile(ASCII_PATTERN)
        self._new = _unassigned()
        # the packed ids of pieces and nothing else: a small table stays in the processor's caches
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    # pieces -----------------------------------------------------------------------------------

    def pieces(self, text: str) -> list[str]:
        """The text cut as the library cuts it; added tokens are pieces of their own."""
        sections = [text]
        if self._split is not None and any(t in text for t in self.special):
            sections = self._split.split(text)
        cut = self._ascii_pattern.findall if text.isascii() else self._pattern.findall
        if not text.isascii() and self._new[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any():
            cut = self._library_pieces
        if len(sections) == 1:
            return cut(text)
        out = []
        for section in sections:
            out.extend([section] if section in self.special else cut(section))
        return out

    def _library_pieces(self, text: str) -> list[str]:
        return [text[s:e] for _, (s, e) in self._library.pre_tokenizer.pre_tokenize_str(text)]

    # tokens of one piece ----------------------------------------------------------------------

    def _plain(self, parts: list[bytes]) -> list[list[int]]:
        """Tokens of byte strings, each taken as one piece."""
        spelled = [p.decode("latin-1").translate(self._table) for p in parts]
        return [[t.id for t in self._model.tokenize(p)] for p in spelled]

    def tokens(self, piece: bytes) -> list[int]:
        """Tokens of one piece; a long one is encoded in halves."""
        if len(piece) <= PIECE:
            return self._plain([piece])[0]
        half = len(piece) // 2
        return self.meet(self.tokens(piece[:half]), self.tokens(piece[half:]))

    def meet(self, a: list[int], b: list[int]) -> list[int]:
        """Tokens of one piece from those of its two parts: a growing window around the join."""
        wide = 1
        while True:
            left, right = a[-wide:], b[:wide]
            got = self._plain([b"".join([self.bytes[i] for i in left + right])])[0]
            if (wide >= len(a) or got[0] == left[0]) and (wide >= len(b) or got[-1] == right[-1]):
                return a[:-wide] + got + b[wide:]
            wide *= 2

    def learn(self, pieces: list[str]) -> list[bytes]:
        """The packed ids of each piece; what was met before is remembered, in two generations."""
        known = self._known
        new = set(pieces).difference(known)
        if new:
            if len(known) + len(new) > REMEMBERED:
                self._before, self._known = known, {}
                known, new = self._known, set(pieces)
            again = [p for p in new if p in self._before]
            known.update((p, self._before[p]) for p in again)
            new.difference_update(again)
            plain = [p for p in new if p not in self.special and len(p) * 4 <= PIECE]
            for p, ids in zip(plain, self._plain([p.encode() for p in plain])):
                known[p] = array("H", ids).tobytes()
            for p in new.difference(plain):
                known[p] = array("H", [self.special[p]] if p in self.special else self.tokens(p.encode())).tobytes()
        return list(map(known.__getitem__, pieces))

    # segments ---------------------------------------------------------------------------------

    def encode(self, text: str) -> Segment:
        packed = self.learn(self.pieces(text))
        ids = np.frombuffer(b"".join(packed), ID)
        first = np.zeros(len(ids), bool)
        if packed:
            end = np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed))) // ID.itemsize
            first[0] = True
            first[end[:-1]] = True
        return Segment(ids, first)

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the printed ids and of the text that they decode to."""
        return self.digests_of(b"".join(self.learn(self.pieces(text))))

    def digests_of(self, packed: bytes) -> tuple[int, str, str]:
        ids = np.frombuffer(packed, ID).tolist()
        return len(ids), _sha(",".join(map(self.shown.__getitem__, ids))), _sha(self.decode(ids))

    def _bytes(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    @staticmethod
    def _spans(at: np.ndarray, starts: np.ndarray, stop: int) -> tuple[dict[int, int], dict[int, int]]:
        """For pieces that begin at tokens ``starts``: byte to token, and first byte to last."""
        edge = [*at[starts].tolist(), int(at[stop])]
        return dict(zip(edge, starts.tolist())), dict(zip(edge, edge[1:]))

    def join(self, a: Segment, b: Segment) -> Segment:
        """The encoding of the text of ``a`` followed by that of ``b``."""
        if not len(a.ids) or not len(b.ids):
            return a if len(a.ids) else b
        # the last piece of a that starts before the margin: everything up to it stands
        a_at = np.concatenate(([0], np.cumsum(self.length[a.ids])))
        a_starts = np.flatnonzero(a.first)
        sure = a_starts[a_at[a_starts] <= a_at[-1] - MARGIN]
        keep = int(sure[-1]) if len(sure) else 0
        left = self._bytes(a.ids[keep:])
        cut = len(left)
        a_token, a_end = self._spans(a_at - a_at[keep], a_starts[a_starts >= keep], len(a.ids))
        a_last = int(a_at[a_starts[-1]] - a_at[keep])

        b_at = np.concatenate(([0], np.cumsum(self.length[b.ids])))
        b_starts = np.append(np.flatnonzero(b.first), len(b.ids))
        reach = 4 * MARGIN
        while True:
            k = min(int(np.searchsorted(b_at[b_starts], reach)), len(b_starts) - 1)
            upto = int(b_starts[k])
            whole = k == len(b_starts) - 1
            text = left + self._bytes(b.ids[:upto])
            b_token, b_end = self._spans(cut + b_at, b_starts[:k], upto)
            b_token[len(text)] = upto
            pieces, stop, at = [], None, 0
            for p in self.pieces(text.decode()):
                end = at + len(p.encode())
                pieces.append((at, end, p))
                at = end
                if end >= cut and end in b_token and (whole or end <= len(text) - MARGIN):
                    stop = end
                    break
            if stop is not None:
                break
            reach *= 4
        ids: list[int] = []
        first: list[int] = []
        for s, e, p in pieces:
            first.append(len(ids))
            if p in self.special:
                ids.append(self.special[p])
            elif a_end.get(s) == e:  # a piece of a as it was
                ids.extend(a.ids[a_token[s]:a_token.get(e, len(a.ids))].tolist())
            elif b_end.get(s) == e:
                ids.extend(b.ids[b_token[s]:b_token[e]].tolist())
            elif s < cut < e:
                one = a.ids[a_token[s]:].tolist() if s == a_last else self.tokens(text[s:cut])
                two = b.ids[:b_token[e]].tolist() if b_end[cut] == e else self.tokens(text[cut:e])
                ids.extend(self.meet(one, two))
            else:
                ids.extend(self.tokens(text[s:e]))
        begins = np.zeros(len(ids), bool)
        begins[first] = True
        rest = b_token[stop]
        return Segment(np.concatenate((a.ids[:keep], np.array(ids, ID), b.ids[rest:])),
                       np.concatenate((a.first[:keep], begins, b.first[rest:])))

    def fold(self, parts: list[Segment]) -> Segment:
        """Neighbours joined pairwise, level by level."""
        while len(parts) > 1:
            parts = [self.join(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def decode(self, ids) -> str:
        """The text of ids, added tokens included; broken UTF-8 shows as the replacement character."""
        return self._bytes(ids).decode("utf-8", "replace")


_CODERS: dict[str, Coder] = {}


def coder(named: tuple[str, str]) -> Coder:
    """One coder a worker and vocabulary (its name and content), so that what it remembers serves all batches."""
    name, content = named
    if name not in _CODERS:
        _CODERS[name] = Coder(content)
    return _CODERS[name]


def read_vocabulary(path: str) -> tuple[str, str]:
    """Name (SHA-256) and content of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    return _sha(content), content


def leaves(text: str, leaf: int) -> list[str]:
    """The text cut in halves until no part is longer than ``leaf`` code points."""
    n = 1
    while -(-len(text) // n) > leaf:
        n *= 2
    cut = [len(text) * i // n for i in range(n + 1)]
    return [text[s:e] for s, e in zip(cut, cut[1:])]


def _sha(data: str | bytes) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


_DIGEST = T.StructType().add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
_RUN = T.StructType().add("name", "string").add("idx", "long").add("n", "long").add("leaves", T.ArrayType(T.StringType()))
_SEGMENT = (T.StructType().add("name", "string").add("idx", "long").add("n", "long")
            .add("ids", "binary").add("first", "binary"))
_SEGMENT = T.StructType([*_SEGMENT.fields, *_DIGEST.fields])  # of complete texts, where these are wanted


def _batch(schema: T.StructType, columns: list) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    want = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                                       for c, f in zip(columns, want)], names=want.names)


def _short(docs: DataFrame, text: str, shared, leaf: int, prefix: str, keep: list) -> DataFrame:
    """Every row with its digests; those of long texts are null and the text's name is given instead."""
    schema = T.StructType([*keep, *(T.StructField(prefix + f.name, f.dataType) for f in _DIGEST.fields),
                           T.StructField("__t_name", T.StringType())])

    def run(batches):
        code = coder(shared.value)
        for b in batches:
            texts = [x or "" for x in b.column(b.schema.get_field_index(text)).to_pylist()]
            got = [code.digests(x) if len(x) <= leaf else (None, None, None) for x in texts]
            name = [_sha(x) if len(x) > leaf else None for x in texts]
            n, ids, back = zip(*got) if got else ((), (), ())
            yield _batch(schema, [b.column(b.schema.get_field_index(f.name)) for f in keep] + [list(n), list(ids), list(back), name])

    return docs.mapInArrow(run, schema)


def _runs(docs: DataFrame, text: str, leaf: int, fan_in: int) -> DataFrame:
    """The leaves of long texts in runs of ``fan_in`` neighbours: name of the text, number of the run, of all runs."""
    def run(batches):
        for b in batches:
            for x in b.column(0).to_pylist():
                parts = leaves(x, leaf)
                cut = [parts[i:i + fan_in] for i in range(0, len(parts), fan_in)]
                yield _batch(_RUN, [[_sha(x)] * len(cut), range(len(cut)), [len(cut)] * len(cut), cut])

    long = docs.select(F.col(text).alias("text")).where(F.char_length("text") > leaf)
    return long.mapInArrow(run, _RUN)


def _segment(code: Coder, name: str, idx: int, n: int, whole: Segment, digests: bool) -> tuple:
    """A row of ``_SEGMENT``; with ``digests``, those of a complete text take the place of its ids."""
    if digests and n == 1:
        return name, idx, n, None, None, *code.digests_of(whole.ids.tobytes())
    return name, idx, n, whole.ids.tobytes(), np.packbits(whole.first).tobytes(), None, None, None


def _joined(rows: DataFrame, shared, fan_in: int, digests: bool = False) -> DataFrame:
    """A round: the leaves of each run, or ``fan_in`` neighbouring segments, become one segment."""
    def encode(batches):
        code = coder(shared.value)
        for b in batches:
            for i in range(0, b.num_rows, RUNS):
                got = [_segment(code, r["name"], r["idx"], r["n"], code.fold([code.encode(x) for x in r["leaves"]]), digests)
                       for r in b.slice(i, RUNS).to_pylist()]
                yield _batch(_SEGMENT, list(map(list, zip(*got))))

    def join(table: pa.Table) -> pa.Table:
        code = coder(shared.value)
        rows = sorted(table.to_pylist(), key=lambda r: r["idx"])
        ids = [np.frombuffer(r["ids"], ID) for r in rows]
        parts = [Segment(i, np.unpackbits(np.frombuffer(r["first"], np.uint8), count=len(i)).astype(bool))
                 for i, r in zip(ids, rows)]
        one = rows[0]
        got = _segment(code, one["name"], one["idx"] // fan_in, -(-one["n"] // fan_in), code.fold(parts), digests)
        return pa.Table.from_batches([_batch(_SEGMENT, [[x] for x in got])])

    if "leaves" in rows.columns:
        return rows.mapInArrow(encode, _SEGMENT)
    grouped = rows.withColumn("part", F.floor(F.col("idx") / fan_in)).groupBy("name", "part")
    return grouped.applyInArrow(join, _SEGMENT)


def encode_long(docs: DataFrame, text: str, shared, leaf: int = LEAF, fan_in: int = FAN_IN, digests: bool = False) -> DataFrame:
    """(name, ids, first) of every distinct text of more than ``leaf`` code points; name is its SHA-256.

    With ``digests``, the name and the columns of ``_DIGEST`` instead.
    """
    rows, whole, most = _runs(docs, text, leaf, fan_in).distinct(), [], 2  # copies of a text meet run by run, combined map-side
    while most > 1:  # log(leaves of the longest text) rounds
        segments = stored(_joined(rows, shared, fan_in, digests), "bpe-joined")
        # texts that are one segment by now stay where they are
        whole.append(segments.where("n = 1"))
        rows, most = segments.where("n > 1"), segments.agg(F.max("n")).first()[0] or 1
    names = ["name", *(_DIGEST.names if digests else ("ids", "first"))]
    return reduce(DataFrame.unionByName, whole).select(*names)


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text", prefix: str = "", leaf: int = LEAF,
               fan_in: int = FAN_IN, drop_text: bool = False) -> DataFrame:
    """The rows of ``docs`` with n_tokens, ids_sha256 (printed ids, comma-joined) and decoded_sha256.

    ``vocabulary`` is the path of the tokenizer file on the driver. Columns are named ``prefix + ...``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    keep = [f for f in docs.schema.fields if not (drop_text and f.name == text)]
    marked = stored(_short(docs, text, shared, leaf, prefix, keep), "bpe-short")
    names = [F.col(f"`{f.name}`") for f in keep] + [F.col(f"`{prefix}{f.name}`") for f in _DIGEST.fields]
    done = marked.where("__t_name is null").select(*names)
    open_ = marked.where("__t_name is not null").drop(*[prefix + f.name for f in _DIGEST.fields])
    found = encode_long(docs, text, shared, leaf, fan_in, digests=True)
    found = found.select(F.col("name").alias("__t_key"), *[F.col(f.name).alias(f"__t_{f.name}") for f in _DIGEST.fields])
    filled = join_skewed(open_, found, "__t_name", "__t_key")
    return done.unionByName(filled.select(
        *names[:len(keep)], *[F.col(f"__t_{f.name}").alias(prefix + f.name) for f in _DIGEST.fields]))


def tokenize(docs: DataFrame, vocabulary: str, text: str = "text", out: str = "ids", leaf: int = LEAF,
             fan_in: int = FAN_IN) -> DataFrame:
    """The rows of ``docs`` with the ids of their text as an array of ints."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    named = docs.withColumn("__t_name", F.when(F.char_length(text) > leaf, F.sha2(F.col(text), 256)))
    schema = T.StructType([*named.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])

    def here(batches):
        code = coder(shared.value)
        for b in batches:
            texts = [x or "" for x in b.column(b.schema.get_field_index(text)).to_pylist()]
            yield _batch(schema, [*b.columns, [code.encode(x).ids.astype(np.int32) if len(x) <= leaf else None for x in texts]])

    def spelled(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                [np.frombuffer(x, ID).astype(np.int32) for x in b.column(1).to_pylist()], pa.list_(pa.int32()))], names=["__t_key", "__t_ids"])

    whole = encode_long(docs, text, shared, leaf, fan_in).select("name", "ids")
    long = join_skewed(named.where("__t_name is not null"), whole.mapInArrow(spelled, "__t_key string, __t_ids array<int>"),
                        "__t_name", "__t_key")
    own = [F.col(f"`{c}`") for c in docs.columns]
    return named.where("__t_name is null").mapInArrow(here, schema).select(*own, F.col(f"`{out}`")).unionByName(
        long.select(*own, F.col("__t_ids").alias(out)))


def detokenize(rows: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with the text that their ids spell, added tokens included; null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        code = coder(shared.value)
        for b in batches:
            yield _batch(schema, [*b.columns, [code.decode(x or []) for x in b.column(b.schema.get_field_index(ids)).to_pylist()]])

    return rows.mapInArrow(run, schema)
