"""Personal data: base rules, and a character BiLSTM with CRF transitions.

The network tags characters (outside, or begin / inside of email, ip, card, phone). It reads
windows of ``WINDOW`` bytes that overlap by ``OVERLAP`` and cover every text from end to end; windows are
decoded one by one and reconciled over the whole text: where two overlap, each character takes its
tag from the window in which it is farther from the border. Base findings always stay; a decoded
span is added where letters or digits of it lie outside of them and its mean marginal probability is
``SURE`` or more. What the rules check by counting (a card's check digit, an address's parts) is checked
on decoded spans too. Windows in which the path without any finding has more than ``1 - SURE`` of the
probability need no decoding: no character of a finding can be as sure as that (a tenth more leaves
room for single precision). Equal windows of a slice are read once.

Training: at most ``rows`` (``TRAIN_ROWS``) texts chosen by hash, labelled by the base rules, plus
``MADE_ROWS`` made lines of each shape from a fixed seed, common and unusual spellings. Windows of
``TRAIN_WIDTH`` bytes are drawn by a fixed seed: at most ``windows`` (``TRAIN_WINDOWS``) of them, a sixth for
the findings of each kind, so that rare kinds are learned too, a twelfth around at signs and groups of
seven or more digits that are none, a quarter anywhere. Windows with a number that only fails the count
are left out, as nothing else tells it from a finding. Everything else covers all texts, whole.

Defined results: null text is empty; offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm import nets, scan
from daypulse.llm import textbatch as tb

TRAIN_ROWS = 2000
TRAIN_WINDOWS = 1500
MADE_ROWS = 40
TRAIN_WIDTH = 96
WINDOW = 320
OVERLAP = 40
#: Units of the network each way.
HIDDEN = 16
#: Windows that the network reads at once.
BATCH = 384
#: Bytes of a slice of texts, whose windows are read and decoded together.
SLICE_BYTES = 1 << 21
SURE = 0.98
#: Characters of an email address at most.
LONGEST = 254
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(rb"[A-Za-z0-9._%+-]")
_LOCAL_TABLE = tb.byte_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x25, 0x25), (0x2B, 0x2B), (0x2D, 0x2E), (0x5F, 0x5F)])
_DOMAIN = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never begins inside a run of digits, so the look-behind changes nothing but the time taken
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
_GROUP = re.compile(rb"[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
_DIGIT = tb.byte_table([(0x30, 0x39)])
_WORDY = tb.byte_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


def _digits(x: bytes) -> bytes:
    return bytes(c for c in x if 48 <= c <= 57)


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = c - 48
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def base_spans(raw: bytes, data: np.ndarray, a: int, z: int, has_at: bool = True) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the rules' matches in ``raw[a:z]``, in the order of kinds, then start."""
    out = []
    at, done = (raw.find(b"@", a, z) if has_at else -1), a
    while at >= 0:
        # the local part reaches back over its characters, but not into the last match
        chunk = _LOCAL_TABLE[data[done:at]]
        stop = np.flatnonzero(~chunk)
        s = done + (int(stop[-1]) + 1 if len(stop) else 0)
        m = _DOMAIN.match(raw, at, z) if s < at else None
        if m:
            out.append((0, s, m.end()))
            done = m.end()
        at = raw.find(b"@", max(at + 1, done), z)
    for m in _IP.finditer(raw, a, z):
        if all(len(p.lstrip(b"0")) <= 3 and int(p) <= 255 for p in m[0].split(b".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(raw, a, z):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(raw, a, z):
        if 8 <= len(_digits(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def triggers(raw: bytes, a: int, z: int) -> list[tuple[int, int]]:
    """Places with the base rules' cues, for training: at signs and groups of seven or more digits."""
    out = [(m.start(), m.end()) for m in _GROUP.finditer(raw, a, z)]
    at = raw.find(b"@", a, z)
    while at >= 0:
        out.append((at, at + 1))
        at = raw.find(b"@", at + 1, z)
    return sorted(out)


def all_starts(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of overlapping windows that cover the texts ``lo .. hi`` whole, and the text of each."""
    size, step = hi - lo, WINDOW - OVERLAP
    count = np.where(size > 0, np.maximum(-(-(size - WINDOW) // step), 0) + 1, 0)
    text = np.repeat(np.arange(len(lo)), count)
    return lo[text] + step * (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)), text


def symbols(data: np.ndarray, starts: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int = WINDOW) -> np.ndarray:
    at = starts[:, None] + np.arange(width)
    ok = (at >= lo[:, None]) & (at < hi[:, None])
    return np.where(ok, nets.SYMBOL[data[np.clip(at, 0, max(len(data) - 1, 0))]], 0)


def _tags(spans, start: int) -> np.ndarray:
    y = np.zeros(TRAIN_WIDTH, np.int64)
    for kind, s, e in spans:
        if e > start and s < start + TRAIN_WIDTH:
            y[max(s - start, 0):e - start] = 2 + 2 * kind
            if s >= start:
                y[s - start] = 1 + 2 * kind
    return y


def _card(rng, digits: int = 16) -> str:
    body = [int(x) for x in rng.integers(0, 10, digits - 1)]
    body[0] = int(rng.integers(3, 7))
    return next(s for last in range(10) if luhn((s := "".join(map(str, [*body, last]))).encode()))


def _shapes(rng: np.random.Generator) -> list:
    """(kind, writer) of the made findings, with spellings that the rules know and others."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    w = lambda: "".join(rng.choice(list("aeioulnrstdmhv"), int(rng.integers(2, 9))))
    end = lambda: str(rng.choice(["com", "org", "net", "io", "co.uk", "de"]))
    ip = lambda: ".".join(str(x) for x in rng.integers(0, 256, 4))
    cut = lambda by, n=16: by.join(c[i:i + 4] for c in [_card(rng, n)] for i in range(0, n, 4))
    hex4 = lambda: f"{rng.integers(0, 65536):x}"
    cc = lambda: str(rng.integers(1, 99))
    return [
        (0, lambda: f"{w()}.{d(2)}@{w()}.{end()}"), (0, lambda: f"{w()}@{w()}.{end()}"), (0, lambda: f"{w()}{d(3)}@{w()}-{w()}.{end()}"),
        (0, lambda: f"{w()}.{w()} at {w()} dot {end()}"), (0, lambda: f"{w()} [at] {w()} [dot] {end()}"), (0, lambda: f"{w()}(at){w()}.{end()}"),
        (1, ip), (1, lambda: ":".join(hex4() for _ in range(8))), (1, lambda: f"fe80::{hex4()}:{hex4()}:{hex4()}"),
        (2, lambda: _card(rng)), (2, lambda: cut(" ")), (2, lambda: cut("-")), (2, lambda: cut("/")),
        (2, lambda: _card(rng, int(rng.integers(16, 20)))),
        (3, lambda: f"+{cc()} ({d(3)}) {d(3)}-{d(4)}"), (3, lambda: f"+{cc()} {d(3)} {d(3)} {d(4)}"), (3, lambda: f"+{cc()}{d(10)}"),
        (3, lambda: f"+{cc()}-{d(3)}-{d(3)}-{d(4)}"), (3, lambda: f"({d(3)}) {d(3)}-{d(4)}"),
        (None, lambda: d(int(rng.integers(7, 13)))), (None, lambda: f"{d(4)}-{d(2)}-{d(2)} {d(2)}:{d(2)}"), (None, lambda: f"{d(3)}.{d(2)}"),
        (None, lambda: f"{d(1)}.{d(1)}.{d(2)}"), (None, lambda: f"{w()} at {w()} dot")]


def _made(rng: np.random.Generator, rows: int = MADE_ROWS) -> list[tuple[bytes, list]]:
    """Lines with one finding (or a look-alike) each and its span, ``rows`` of every shape, by fixed seed."""
    out = []
    w = lambda: "".join(rng.choice(list("aeioulnrstdmhvbcgp"), int(rng.integers(2, 10))))
    lead = ["call", "mail", "card", "from", "host", "tel", "contact", "see", "ref", "no"]
    for kind, write in _shapes(rng):
        for i in range(rows):
            words = [w() for _ in range(int(rng.integers(0, 9)))]
            head = " ".join([*words, *([str(rng.choice(lead)) + ("" if i % 2 else ":")] if i % 3 else [])])
            body = write()
            head += str(rng.choice([" ", "\n", ", "])) if head else ""
            line = head + body + str(rng.choice([" ", ", ", "\n", ". ", ""]))
            line += " ".join(w() for _ in range(int(rng.integers(0, 9)))) if not line.endswith(body) else ""
            out.append((line.encode(), [] if kind is None else [(kind, len(head), len(head) + len(body))]))
    return out


def counted_out(kind: int, body: bytes) -> bool:
    """The text of a card or address fails the count that the rules make: it is none, whatever it looks like."""
    if kind == 0:
        return len(body) > LONGEST
    if kind == 1 and b":" not in body:
        parts = body.split(b".")
        return len(parts) != 4 or any(not p.isdigit() or int(p) > 255 for p in parts)
    digits = _digits(body)
    return kind == 2 and not (13 <= len(digits) <= 19 and luhn(digits))


def near_misses(raw: bytes) -> list[tuple[int, int]]:
    """Places that look like a card or an address and fail the count."""
    cards = [m.span() for m in _CARD.finditer(raw) if len(_digits(m[0])) >= 13 and counted_out(2, m[0])]
    return cards + [m.span() for m in _IP.finditer(raw) if counted_out(1, m[0])]


def train(texts: list[bytes], seed: int = 5, windows: int = TRAIN_WINDOWS) -> nets.BiLstmCrf:
    rng = np.random.default_rng(seed)
    rows = []
    for text in texts:
        rows.append((text, base_spans(text, np.frombuffer(text, np.uint8), 0, len(text))))
    rows += _made(rng)
    kinds: list[list] = [[] for _ in range(len(KINDS) + 2)]  # places of each kind, of cues that are none, anywhere
    for i, (text, spans) in enumerate(rows):
        for kind, s, e in spans:
            kinds[kind].append((i, s, e))
        kinds[-2] += [(i, s, e) for s, e in triggers(text, 0, len(text)) if not any(s < y and x < e for _, x, y in spans)]
        kinds[-1].append((i, int(rng.integers(0, max(len(text), 1))), 0))
    xs, ys = [], []
    for k, places in enumerate(kinds):
        share = windows // (6 if k < len(KINDS) else 12 if k == len(KINDS) else 4)
        for j in np.sort(rng.permutation(len(places))[:share]):
            i, s, e = places[j]
            text, spans = rows[i]
            room = max(TRAIN_WIDTH - max(e - s, 0), 1)
            start = max(s - int(rng.integers(0, room)), 0)
            if any(x < start + TRAIN_WIDTH and start < y for x, y in near_misses(text)):
                continue
            data = np.frombuffer(text, np.uint8)
            xs.append(symbols(data, np.array([start]), np.array([0]), np.array([len(data)]), TRAIN_WIDTH))
            ys.append(_tags(spans, start))
    return nets.BiLstmCrf(1 + 2 * len(KINDS), hidden=HIDDEN).fit(np.concatenate(xs), np.stack(ys))


def _batches(starts: np.ndarray, hi: np.ndarray):
    """Windows in groups of similar length, and the width that holds each group."""
    size = np.minimum(hi - starts, WINDOW)
    order = np.argsort(size, kind="stable")
    for c in range(0, len(order), BATCH):
        some = order[c:c + BATCH]
        yield some, int(size[some[-1]])


def _decoded(model, data: np.ndarray, starts: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Tags and their probabilities, a row of WINDOW each; beyond a text's end nothing is found."""
    tags, sure = np.zeros((len(starts), WINDOW), np.int64), np.ones((len(starts), WINDOW))
    for some, width in _batches(starts, hi):
        t, p = model.decode(symbols(data, starts[some], lo[some], hi[some], width))
        tags[some, :width], sure[some, :width] = t, p
    return tags, sure


def _reconciled(starts: np.ndarray, tags: np.ndarray, sure: np.ndarray, z: int) -> list[tuple[int, int, int, float]]:
    """Spans (kind, start, end, mean probability) of one text from its windows."""
    at = starts[:, None] + np.arange(WINDOW)
    inner = np.minimum(np.arange(WINDOW), WINDOW - 1 - np.arange(WINDOW))
    depth = np.broadcast_to(inner, at.shape)
    flat, order = at.ravel(), np.lexsort((-depth.ravel(), at.ravel()))
    flat = flat[order]
    first = np.concatenate(([True], flat[1:] != flat[:-1])) & (flat < z)
    place, tag, p = flat[first], tags.ravel()[order][first], sure.ravel()[order][first]
    out, i = [], 0
    while i < len(place):
        if tag[i] == 0:
            i += 1
            continue
        kind, j = (int(tag[i]) - 1) // 2, i + 1
        while j < len(place) and place[j] == place[j - 1] + 1 and tag[j] == 2 + 2 * kind:
            j += 1
        out.append((kind, int(place[i]), int(place[j - 1]) + 1, float(p[i:j].mean())))
        i = j
    return out


def _loud(model, data: np.ndarray, starts: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which windows must be decoded; of equal ones one is read."""
    raw, end = data.tobytes(), np.minimum(starts + WINDOW, hi)
    known: dict[bytes, int] = {}
    same = np.fromiter((known.setdefault(raw[s:e], len(known)) for s, e in zip(starts.tolist(), end.tolist())), np.int64, len(starts))
    _, one = np.unique(same, return_index=True)
    loud = np.zeros(len(one), bool)
    for some, width in _batches(starts[one], hi[one]):
        i = one[some]
        loud[some] = ~model.quiet(symbols(data, starts[i], lo[i], hi[i], width), 1.1 * (1 - SURE))
    return loud[same]


def _sticks_out(data: np.ndarray, s: int, e: int, spans) -> bool:
    """Letters or digits of the span lie outside of all ``spans``."""
    left = _WORDY[data[s:e]].copy()
    for _, x, y in spans:
        left[max(x - s, 0):max(y - s, 0)] = False
    return bool(left.any())


def find_slice(model: nets.BiLstmCrf, data: np.ndarray, offs: np.ndarray) -> tuple[list, list]:
    """Base and added spans (text, kind, start, end) of a slice, in bytes."""
    raw = data.tobytes()
    digit = np.concatenate(([0], np.cumsum(_DIGIT[data], dtype=np.int64)))
    with_at = scan.holding(raw, offs, (b"@",))
    with_digit = digit[offs[1:]] - digit[offs[:-1]] >= 4  # the rules, not the network, need at signs or digits
    base, own = [], {}
    for row in np.flatnonzero(with_at | with_digit).tolist():
        own[row] = base_spans(raw, data, int(offs[row]), int(offs[row + 1]), bool(with_at[row]))
        base += [(row, *x) for x in own[row]]
    added = []
    starts, text = all_starts(offs[:-1], offs[1:])
    loud = _loud(model, data, starts, offs[text], offs[text + 1])
    if loud.any():
        tags, sure = np.zeros((len(starts), WINDOW), np.int64), np.ones((len(starts), WINDOW))
        tags[loud], sure[loud] = _decoded(model, data, starts[loud], offs[text[loud]], offs[text[loud] + 1])
        near = loud.copy()  # windows that overlap a decoded one count where they reach deeper
        near[1:] |= loud[:-1]
        near[:-1] |= loud[1:]
        for row in np.unique(text[loud]).tolist():
            i = np.searchsorted(text, row) + np.flatnonzero(near[text == row])
            for kind, s, e, p in _reconciled(starts[i], tags[i], sure[i], int(offs[row + 1])):
                if p >= SURE and not counted_out(kind, raw[s:e]) and _sticks_out(data, s, e, own.get(row, ())):
                    added.append((row, kind, s, e))
    return base, added


def fit_model(docs: DataFrame, text: str = "text", rows: int = TRAIN_ROWS, windows: int = TRAIN_WINDOWS) -> nets.BiLstmCrf:
    """Train on at most ``rows`` texts and ``windows`` windows."""
    return train(scan.sample_texts(docs, text, rows, 13), windows=windows)


def find(docs: DataFrame, model: nets.BiLstmCrf, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    none = scan.sha("")
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            counts = np.zeros((b.num_rows, 4), np.int64)
            digest, spans = [none] * b.num_rows, [""] * b.num_rows
            for s in tb.slices(b.column(1), SLICE_BYTES):
                base, added = find_slice(model, s.data, s.offs)
                if not (base or added):
                    continue
                cp = scan.code_points(s.data)
                own: dict[int, tuple[list, list]] = {}
                for which, some in ((0, base), (1, base), (1, added)):
                    for row, k, x, y in some:
                        first = cp[s.offs[row]]
                        own.setdefault(row, ([], []))[which].append((k, int(cp[x] - first), int(cp[y] - first)))
                        if which == 0:
                            counts[s.first + row, k] += 1
                for row, (mine, everything) in own.items():
                    if mine:
                        digest[s.first + row] = scan.sha(scan.joined((KINDS[k], x, y) for k, x, y in sorted(mine)))
                    spans[s.first + row] = scan.joined((KINDS[k], x, y) for k, x, y in sorted(everything))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(counts[:, k]) for k in range(4)], pa.array(digest, pa.string()),
                 pa.array(spans, pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return slim.mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                                "base_sha256 string, spans string")
