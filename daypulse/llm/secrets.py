"""Secret scans: base rules, and a character convolutional network over every candidate.

A candidate is any run of 16 or more token characters. The network sees it with its surrounding
context, in one window of ``WIDTH`` bytes or, where it is longer than ``WIDTH - LEFT``, in overlapping
windows every ``LEFT`` bytes until the context after its end has been read; the greatest of their
calibrated probabilities is the candidate's. The threshold is the largest
that keeps the wanted recall on held-out labelled findings. Findings of the base rules always
stay; the network adds candidates, whole, as spans of kind ``cnn``, also those that stick out of
base findings. Only candidates that lie within base findings are not scored.

Training: at most ``rows`` (``TRAIN_ROWS``) texts, chosen by hash, whose base findings are the
labelled positives and whose other candidates and plain tokens are the negatives, plus ``MADE_ROWS``
made findings and look-alikes (dates, versions, numbers, paths) from a fixed seed, so that a corpus
without secrets can be scanned too. All windows of positives are trained on or held out; of the other
windows as many, by a fixed seed, as make up ``windows`` (``TRAIN_WINDOWS``) with them, and half that
number at least. A candidate that no rule knows may still be a secret: a first fit on the labelled
and made rows decides which of them are left out as negatives. Candidates are searched for in all
texts, whole.

Defined results: null text is empty; offsets are code points, ends exclusive; repeated rows get
equal results.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm import nets, scan
from daypulse.llm import textbatch as tb

TRAIN_ROWS = 2000
TRAIN_WINDOWS = 4000
MADE_ROWS = 600
LEFT, WIDTH = 24, 72
KINDS = ("assign", "access", "hex", "cnn")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX = tb.byte_table([(0x30, 0x39), (0x61, 0x66)])
_TOKEN = tb.byte_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x2B, 0x2B), (0x2D, 0x2D), (0x2F, 0x2F),
                        (0x3D, 0x3D), (0x5F, 0x5F)])


def base_spans(data: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, kind, start, end) in bytes of the slice, of the rules' matches that hold."""
    raw = data.tobytes()
    low = tb.LOWER[data].tobytes()
    out = []
    for row in np.flatnonzero(scan.holding(low, offs, _WORDS)):
        for m in ASSIGN.finditer(raw, int(offs[row]), int(offs[row + 1])):
            if m.end(2) - m.start(2) >= 12:
                out.append((int(row), 0, m.start(), m.end()))
    for row in np.flatnonzero(scan.holding(raw, offs, (b"AKIA",))):
        for m in ACCESS.finditer(raw, int(offs[row]), int(offs[row + 1])):
            if m.end() - m.start() >= 18:
                out.append((int(row), 1, m.start(), m.end()))
    for s, e, row in zip(*scan.runs(_HEX[data], offs, 16)):
        out.append((int(row), 2, int(s), int(e)))
    return out


def candidates(data: np.ndarray, offs: np.ndarray):
    """Runs of 16 or more token characters: start, end, text."""
    return scan.runs(_TOKEN[data], offs, 16)


def windows(data: np.ndarray, s: np.ndarray, e: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray | None = None):
    """Symbols and candidate marks of the context windows, at ``s`` or the places ``at``; nothing outside ``lo .. hi`` is seen."""
    at = (s if at is None else at)[:, None] - LEFT + np.arange(WIDTH)
    inside = (at >= lo[:, None]) & (at < hi[:, None])
    x = np.where(inside, nets.SYMBOL[data[np.clip(at, 0, max(len(data) - 1, 0))]], 0).astype(np.int16)
    return x, (inside & (at >= s[:, None]) & (at < e[:, None])).astype(np.float64)


def slid(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places windows are laid at (``s`` of ``windows``) to read the candidates and LEFT bytes after them, and whose each is."""
    more = np.where(e - s > WIDTH - LEFT, -(-(e - s + 2 * LEFT - WIDTH) // LEFT), 0)
    own = np.repeat(np.arange(len(s)), more + 1)
    return s[own] + LEFT * (np.arange(len(own)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)), own


def _made(rng: np.random.Generator, rows: int):
    """Findings and look-alikes in made contexts, as (text, start, end, label)."""
    chars = np.frombuffer(b"0123456789abcdefABCDEFGHIJKLMNOPQRSTUVWXYZghijklmnopqrstuvwxyz+/_", np.uint8)
    word = lambda n: bytes(rng.choice(chars[10:16 + 46], n)).lower().decode("ascii", "ignore")
    pick = lambda a, n: bytes(rng.choice(a, n)).decode()
    out = []
    for i in range(rows):
        n = int(rng.integers(20, 44))
        good = i % 2 == 0
        if good:
            body = [lambda: pick(chars[:16], n), lambda: pick(chars, n), lambda: pick(chars[:16], n).upper(),
                    lambda: "AKIA" + pick(chars[:10], 8) + pick(chars[16:42], 8),
                    lambda: "ghp_" + pick(chars[:-2], n)][i // 2 % 5]()
            lead = ["token = \"", "key: ", "secret='", "Authorization: Bearer ", "export KEY=", " "][i // 2 % 6]
        else:
            d = lambda k: str(int(rng.integers(10 ** (k - 1), 10 ** k)))
            body = [lambda: f"{d(4)}-{d(2)}-{d(2)}T{d(2)}", lambda: word(9) + "-" + word(6) + "-" + d(4),
                    lambda: "/".join((word(5), word(7), d(4), word(4))), lambda: "=" * n + d(4),
                    lambda: word(8) + "_" + word(7) + d(4), lambda: "-".join(d(4) for _ in range(4)),
                    lambda: word(18) + d(4)][i // 2 % 7]()
            lead = [" ", "see ", "(", "at ", "id "][i // 2 % 5]
        left = f"{word(6)} {word(4)} {lead}"
        out.append(((left + body + " " + word(5) + " " + word(7)).encode(), len(left), len(left) + len(body), float(good)))
    return out


def bounded(y: np.ndarray, most: int, seed: int) -> np.ndarray:
    """Rows to train on: all positives, and others up to ``most`` rows in all, or half of ``most`` if that is more."""
    other = np.random.default_rng(seed).permutation(np.flatnonzero(y < 0.5))
    return np.sort(np.concatenate((np.flatnonzero(y > 0.5), other[:max(most - int((y > 0.5).sum()), most // 2)])))


def train(texts: list[bytes], seed: int = 7, recall: float = 0.95, rows: int = TRAIN_WINDOWS) -> nets.CharCnn:
    """Fit the network on the texts' own findings and the made rows."""
    xs, marks, ys, known, groups = [], [], [], [], [np.zeros(1, np.int64)]
    for text in texts:
        data, offs = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        found = base_spans(data, offs)
        s, e, _ = candidates(data, offs)
        at, own = slid(s, e)
        s, e = s[own], e[own]
        good = np.array([any(a < min(y, i - LEFT + WIDTH) and max(x, i - LEFT) < b for _, _, a, b in found)
                         for i, x, y in zip(at, s, e)], bool)
        w = tb.words(data, offs)
        far = np.flatnonzero(w.end - w.start >= 10)[:4]  # plain words teach what is none
        taken = [(a, b) for _, _, a, b in found] + list(zip(s, e))
        plain = np.array([not any(a < w.end[i] and w.start[i] < b for a, b in taken) for i in far], bool)
        at = np.concatenate((at, w.start[far[plain]] if len(far) else far)).astype(np.int64)
        s = np.concatenate((s, w.start[far[plain]] if len(far) else far)).astype(np.int64)
        e = np.concatenate((e, w.end[far[plain]] if len(far) else far)).astype(np.int64)
        y = np.concatenate((good, np.zeros(len(s) - len(good), bool)))
        if len(s):
            x, m = windows(data, s, e, np.zeros(len(s), np.int64), np.full(len(s), len(data)), at)
            xs.append(x), marks.append(m), ys.append(y)
            mine = np.concatenate((own, own.max(initial=-1) + 1 + np.arange(len(s) - len(own))))
            groups.append(groups[-1].max() + 1 + mine)
            known.append(np.concatenate((good, np.ones(len(s) - len(good), bool))))
    for text, a, b, good in _made(np.random.default_rng(seed), MADE_ROWS):
        data = np.frombuffer(text, np.uint8)
        x, m = windows(data, np.array([a]), np.array([b]), np.array([0]), np.array([len(data)]))
        xs.append(x), marks.append(m), ys.append(np.array([good > 0.5])), known.append(np.array([True]))
        groups.append(groups[-1].max(keepdims=True) + 1)
    x, mark, y = np.concatenate(xs), np.concatenate(marks), np.concatenate(ys).astype(np.float64)
    keep = bounded(y, rows, seed)
    x, mark, y, known = x[keep], mark[keep], y[keep], np.concatenate(known)[keep]
    group = np.concatenate(groups[1:])[keep]
    first = nets.CharCnn().fit(x[known], mark[known], y[known], epochs=6)
    known[~known] = first.probability(x[~known], mark[~known]) < 0.5
    x, mark, y, group = x[known], mark[known], y[known], group[known]
    return nets.CharCnn().fit(x, mark, y, recall=recall, group=group)


def find_slice(model: nets.CharCnn, data: np.ndarray, offs: np.ndarray) -> tuple[list, list]:
    """Base and added spans (text, kind, start, end) of a slice, in bytes."""
    base = base_spans(data, offs)
    s, e, row = candidates(data, offs)
    if len(s):
        taken = np.zeros(len(data) + 1, np.int64)
        for _, _, a, b in base:
            taken[a] += 1
            taken[b] -= 1
        covered = np.concatenate(([0], np.cumsum(np.cumsum(taken[:-1]) > 0)))
        out = covered[e] - covered[s] < e - s
        s, e, row = s[out], e[out], row[out]
    added = []
    best = np.zeros(len(s))
    at, own = slid(s, e)
    for c in range(0, len(at), 512):
        i = own[c:c + 512]
        r = row[i]
        np.maximum.at(best, i, model.probability(*windows(data, s[i], e[i], offs[r], offs[r + 1], at[c:c + 512])))
    added += [(int(row[i]), 3, int(s[i]), int(e[i])) for i in np.flatnonzero(best >= model.threshold)]
    return base, added


def _rows(model, s: tb.Slice):
    """For each text of a slice: counts of base kinds, base and all spans in code points."""
    base, added = find_slice(model, s.data, s.offs)
    cp = scan.code_points(s.data) if base or added else None
    out = [([0, 0, 0], [], []) for _ in range(len(s.offs) - 1)]
    for which, spans in ((1, base), (2, base), (2, added)):
        for row, kind, a, b in spans:
            first = cp[s.offs[row]]
            out[row][which].append((int(cp[a] - first), kind, int(cp[b] - first)))
            if which == 1:
                out[row][0][kind] += 1
    return out


def _text(spans) -> str:
    return scan.joined((KINDS[k], a, b) for a, k, b in sorted(spans))


def fit_model(docs: DataFrame, text: str = "text", rows: int = TRAIN_ROWS, windows: int = TRAIN_WINDOWS) -> nets.CharCnn:
    """Train on at most ``rows`` texts; ``windows`` bounds the training windows that are no findings."""
    return train(scan.sample_texts(docs, text, rows, 11), rows=windows)


def find(docs: DataFrame, model: nets.CharCnn, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 and spans."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    none = scan.sha("")

    def run(batches):
        for b in batches:
            got = [x for s in tb.slices(b.column(1)) for x in _rows(model, s)]
            counts = [pa.array([x[0][k] for x in got], pa.int64()) for k in range(3)]
            digest = [scan.sha(_text(x[1])) if x[1] else none for x in got]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, pa.array(digest, pa.string()), pa.array([_text(x[2]) for x in got], pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, model: nets.CharCnn, text: str = "text", mark: str = "[SECRET]",
           length: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by ``mark``; ``length``, if there, is the text's new length."""
    names = docs.columns
    at = names.index(text)
    new = mark.encode()

    def run(batches):
        for b in batches:
            texts, sizes = [], []
            old = b.column(at)
            for s in tb.slices(old):
                base, added = find_slice(model, s.data, s.offs)
                raw = s.data.tobytes()
                cuts: dict[int, list] = {}
                for row, _, x, y in sorted(base + added, key=lambda z: z[2]):
                    mine = cuts.setdefault(row, [])
                    if mine and x < mine[-1][1]:
                        mine[-1][1] = max(mine[-1][1], y)
                    else:
                        mine.append([x, y])
                for row in range(len(s.offs) - 1):
                    a, z = int(s.offs[row]), int(s.offs[row + 1])
                    parts = []
                    for x, y in cuts.get(row, ()):
                        parts += [raw[a:x], new]
                        a = y
                    value = b"".join((*parts, raw[a:z])).decode()
                    changed = row in cuts
                    texts.append(value if changed or old[s.first + row].is_valid else None)
                    sizes.append(len(value) if changed else None)
            arrays = list(b.columns)
            arrays[at] = pa.array(texts, pa.string())
            if length in names and pa.types.is_integer(b.column(names.index(length)).type):
                i = names.index(length)
                sizes = pa.array(sizes, b.column(i).type)
                arrays[i] = pc.coalesce(sizes, b.column(i))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.mapInArrow(run, docs.schema)
