"""Vectorised work on the UTF-8 bytes of a text column, one Arrow batch at a time.

Spark hands a partition to ``mapInArrow`` as record batches; the helpers here look
at the batch's own byte buffer with numpy, half a megabyte of whole texts at a time,
so no Python string is made and memory stays bounded by the slice (or the longest
single text). A null text counts as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
#: The Mersenne prime that content hashes are taken modulo, and two bases below it.
PRIME = (1 << 61) - 1
_BASES = (0x1A6B3E9C5D7F2481, 0x0D5A19C4B3E86F73)
_P, _LOW = np.uint64(PRIME), np.uint64(0xFFFFFFFF)
_S29, _S32, _S61, _M29 = np.uint64(29), np.uint64(32), np.uint64(61), np.uint64((1 << 29) - 1)
#: Sums of byte terms stay below 2^64 up to here; longer sequences reduce each term first.
_PLAIN_SUM = 1 << 22
_BLOCK = 1 << 13
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def byte_table(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A 256-entry truth table: true on the given inclusive byte ranges."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi + 1] = True
    return table


#: ``[^\x20\x09-\x0D]+``
NON_SPACE = ~byte_table([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
ALNUM_LOWER = byte_table([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
#: maps A-Z to a-z and leaves every other byte
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Slice(NamedTuple):
    """Whole texts of rows ``first .. first + len(offs) - 2`` of a batch."""

    first: int
    offs: np.ndarray
    data: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of at most ``limit`` bytes, one text at least."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield Slice(i, offs[i:j + 1] - offs[i], data[offs[i]:offs[j]])
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _reduce(x: np.ndarray) -> np.ndarray:
    """64-bit values modulo the prime."""
    x = (x & _P) + (x >> _S61)
    return np.where(x >= _P, x - _P, x)


def _times_2_32(x: np.ndarray) -> np.ndarray:
    """``x * 2^32`` modulo the prime, up to one multiple of it."""
    return (x >> _S29) + ((x & _M29) << _S32)


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, in 32-bit halves (2^61 counts as 1, so 2^64 as 8)."""
    ah, al, bh, bl = a >> _S32, a & _LOW, b >> _S32, b & _LOW
    low = al * bl
    return _reduce(((ah * bh) << np.uint64(3)) + _times_2_32(al * bh + ah * bl) + (low & _P) + (low >> _S61))


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = []
        for x in (_BASES[base], pow(_BASES[base], -1, PRIME)):
            p = np.ones(size, np.uint64)
            k = 1
            while k < size:
                p[k:2 * k] = mulmod(p[:k], np.uint64(pow(x, k, PRIME)))
                k *= 2
            out.append(p)
        have = _POWERS[base] = (out[0], out[1])
    return have


class Rolling:
    """Content hashes of any ranges of a sequence, from one prefix sum.

    The hash of ``seq[s:e]`` is a polynomial in a fixed base modulo 2^61 - 1. It depends on
    the content only (not on ``s``) and is scrambled, so it can name the range across tasks.
    Two different ranges of at most n symbols share a name with a chance of about n / 2^61
    (symbols of 64 bits are taken modulo the prime first, which adds 2^-61 for each).
    """

    def __init__(self, seq: np.ndarray, base: int = 0):
        n = len(seq)
        up, self._down = _powers(n + 1, base)
        up = up[:n]
        if seq.dtype == np.uint8 and n <= _PLAIN_SUM:
            x = seq.astype(np.uint64) + np.uint64(1)
            low, high = (up & _LOW) * x, (up >> _S32) * x
        else:
            x = seq.astype(np.uint64)
            term = mulmod(_reduce(_reduce(x) + np.uint64(1)), up)
            low, high = term & _LOW, term >> _S32
        self._low, self._high = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(low, out=self._low[1:])
        np.cumsum(high, out=self._high[1:])

    def __call__(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        low = self._low[e] - self._low[s]
        raw = _reduce((low & _P) + (low >> _S61) + _times_2_32(self._high[e] - self._high[s]))
        return mix64(mulmod(raw, self._down[s]) ^ ((np.asarray(e) - s).astype(np.uint64) << np.uint64(40)))


    def each(self, width: int) -> np.ndarray:
        """The hashes of all ranges of ``width`` symbols, by start; block by block, so that the terms stay in the cache."""
        n = max(len(self._low) - width, 0)
        out = np.empty(n, np.uint64)
        size = np.uint64(width << 40)
        for a in range(0, n, _BLOCK):
            z = min(a + _BLOCK, n)
            low = self._low[a + width:z + width] - self._low[a:z]
            raw = _reduce((low & _P) + (low >> _S61) + _times_2_32(self._high[a + width:z + width] - self._high[a:z]))
            out[a:z] = mix64(mulmod(raw, self._down[a:z]) ^ size)
        return out


class Words(NamedTuple):
    """Words of a slice in order: byte start and end, and the text (0-based) of each."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray  # first word of each text, with the number of words at the end


def words(data: np.ndarray, offs: np.ndarray, table: np.ndarray = NON_SPACE) -> Words:
    """Maximal runs of bytes in ``table``; none crosses a text border."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = table[data]
    border = np.zeros(n + 1, bool)
    border[offs] = True
    here = inside[1:-1]
    start = np.flatnonzero(here & (~inside[:-2] | border[:n]))
    end = np.flatnonzero(here & (~inside[2:] | border[1:])) + 1
    first = np.searchsorted(start, offs, side="left")
    text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    return Words(start, end, text, first)


def word_hashes(data: np.ndarray, w: Words, base: int = 0) -> np.ndarray:
    return Rolling(data, base)(w.start, w.end)


def sliding_min(a: np.ndarray, length: int) -> np.ndarray:
    """Minimum over each window of ``length`` consecutive values."""
    if len(a) < length:
        return a[:0]
    out, span = a, 1
    while span * 2 <= length:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < length:
        rest = length - span
        out = np.minimum(out[:len(out) - rest], out[rest:])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit names as Spark longs."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def ranges_to_mask(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """True on the union of the half-open ranges."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:n]) > 0


def table_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(k).type) for k, c in
         ((f.name, columns[f.name]) for f in schema)], schema=schema)


def room_for(first: np.ndarray, size: int) -> np.ndarray:
    """For a sequence cut into texts at ``first``: true where ``size`` items fit before the text's end."""
    n = int(first[-1])
    step = np.zeros(n + 1, np.int64)
    fits = np.diff(first) >= size
    np.add.at(step, first[:-1][fits], 1)
    np.add.at(step, first[1:][fits] - size + 1, -1)
    return np.cumsum(step[:n]) > 0


def stable_order(codes: np.ndarray) -> np.ndarray:
    """Stable argsort of non-negative 32-bit codes: one or two 16-bit radix passes."""
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    high = (codes >> 16).astype(np.uint16)
    return order if not high.any() else order[np.argsort(high[order], kind="stable")]
