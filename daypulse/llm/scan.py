"""Helpers for scanning texts for spans on their UTF-8 bytes.

All patterns in use are ASCII, so they match the same places in bytes as in text; offsets are
turned into code points at the end.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daypulse.llm import textbatch as tb


def runs(mask: np.ndarray, offs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the runs of ``mask`` of ``least`` bytes or more, cut at text borders."""
    w = tb.words(mask.view(np.uint8), offs, np.arange(256) == 1)
    ok = w.end - w.start >= least
    return w.start[ok], w.end[ok], w.text[ok]


def holding(data: bytes, offs: np.ndarray, literals: tuple[bytes, ...]) -> np.ndarray:
    """Which texts may contain one of the literals."""
    found = np.zeros(len(offs) - 1, bool)
    for x in literals:
        at = data.find(x)
        while at >= 0:
            row = int(np.searchsorted(offs, at, side="right")) - 1
            found[row] = True
            at = data.find(x, max(at + 1, int(offs[row + 1]) - len(x) + 1))
    return found


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte offset of a slice."""
    return np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def sample_texts(docs: DataFrame, text: str, rows: int, seed: int) -> list[bytes]:
    """At most ``rows`` different whole texts, those with the least hashes: training rows only.

    Copies of a text count once and combine map-side; reruns choose the same texts.
    """
    total = docs.count()
    share = min(1.0, 2 * rows / max(total, 1))
    name = F.xxhash64(F.lit(seed), F.col(text))
    pick = F.pmod(name, F.lit(1 << 20)) <= int(share * (1 << 20))
    got = (docs.where(pick & F.col(text).isNotNull()).select(F.col(text).alias("t")).distinct()
           .orderBy(F.pmod(F.xxhash64(F.lit(seed), F.col("t")), F.lit(1 << 20)), "t").limit(rows).collect())
    return sorted(r.t.encode() for r in got)
