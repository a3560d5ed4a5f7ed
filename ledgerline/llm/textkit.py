"""Vectorised text helpers shared by the operators: Arrow strings as flat UTF-8 bytes.

A batch is cut into slices of at most about ``SLICE_BYTES`` of text (always whole rows), so the
working arrays stay small whatever the batch size; one very long text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 16_384

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_rng = np.random.default_rng(20240229)
BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
LONG_SPAN = 256
_POWERS = {"n": 0, "up": np.ones(0, _U), "down": np.ones(0, _U)}


@dataclass
class Texts:
    """Consecutive rows of a batch: their UTF-8 bytes end to end, and where each row starts."""

    first: int
    data: np.ndarray
    offs: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offs) - 1


def text_slices(col: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Slices of a string column; null counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    if not n:
        return
    _, off_buf, data_buf = col.buffers()
    offs = np.frombuffer(off_buf, dtype=np.int64)[col.offset:col.offset + n + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + SLICE_ROWS, n)
        yield Texts(i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        i = j


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if n > _POWERS["n"]:
        size = max(n, SLICE_BYTES + 1)
        up = np.full(size, BASE, dtype=_U)
        down = np.full(size, BASE_INV, dtype=_U)
        up[0] = down[0] = 1
        _POWERS.update(n=size, up=np.cumprod(up, dtype=_U), down=np.cumprod(down, dtype=_U))
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the constants of splitmix64)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


class PrimeSums:
    """62-bit hashes of ranges of values: two polynomials modulo primes below 2^31.

    A polynomial modulo 2^64 has equal values on strings that are built for it (from 1,024 values on),
    whatever its base; modulo a prime it has not.
    """

    def __init__(self, values: np.ndarray):
        self.parts = []
        for prime, base in PRIMES:
            up, down = _prime_powers(prime, base, len(values) + 1)
            sums = np.zeros(len(values) + 1, dtype=_U)
            # terms are below 2^31, so the sum of 2^33 of them fits
            np.cumsum(values % _U(prime) * up[:len(values)] % _U(prime), out=sums[1:])
            self.parts.append((_U(prime), sums, up, down))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.joined(((starts, ends),))

    def joined(self, ranges) -> np.ndarray:
        """Hash of ranges as if they stood end to end, with the index of their first value given back."""
        out = np.zeros(len(ranges[0][0]), dtype=_U)
        for prime, sums, up, down in self.parts:
            total, before = np.zeros(len(out), dtype=_U), np.zeros(len(out), dtype=np.int64)
            for starts, ends in ranges:
                own = (sums[ends] - sums[starts]) % prime * down[starts] % prime
                total = (total + own * up[before] % prime) % prime
                before = before + (ends - starts)
            out = (out << _U(31)) | total
        return out


#: primes below 2^31, each with a base
PRIMES = ((2147483647, 1103515245), (2147483629, 1759714727))
_PRIME_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _prime_powers(prime: int, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo ``prime`` for i < n (at least), by doubling."""
    known = _PRIME_POWERS.get(prime)
    if known is None or len(known[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        known = []
        for b in (base, pow(base, -1, prime)):
            out = np.ones(size, dtype=_U)
            done = 1
            while done < size:
                more = min(done, size - done)
                out[done:done + more] = out[:more] * _U(pow(b, done, prime)) % _U(prime)
                done += more
            known.append(out)
        _PRIME_POWERS[prime] = known = tuple(known)
    return known


class Spans:
    """64-bit hashes of byte spans, from prefix sums of a polynomial over coded bytes; spans of ``LONG_SPAN``
    bytes or more are hashed modulo primes as well (see ``PrimeSums``)."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.data = data
        self.sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(BYTE_CODES[data] * up[:len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        size = ends - starts
        out = mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + size.astype(_U))
        long = np.flatnonzero(size >= LONG_SPAN)
        if len(long):
            many = size[long]
            if many.sum() < len(self.data):  # few of them: their bytes alone, end to end
                values, stop = gather_spans(self.data, starts[long], many), np.cumsum(many)
                start = stop - many
            else:
                values, start, stop = self.data, starts[long], ends[long]
            out[long] = mix(out[long] ^ PrimeSums(BYTE_CODES[values] >> _U(33))(start, stop))
        return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes that start at ``a`` and at ``b`` are equal, pair by pair."""
    out = np.ones(len(size), dtype=bool)
    ends = np.cumsum(size)
    first = 0
    while first < len(size):
        stop = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + SLICE_BYTES, side="right")))
        some = size[first:stop]
        unlike = gather_spans(data, a[first:stop], some) != gather_spans(data, b[first:stop], some)
        out[first + np.repeat(np.arange(len(some)), some)[unlike]] = False
        first = stop
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(data)(starts, ends)


def word_spans(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words ``[^\\x20\\x09-\\x0D]+`` of a slice."""
    ink = ~WHITE[t.data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    inner = t.offs[1:-1]
    inner = inner[inner < len(ink)]
    first[inner] = ink[inner]
    starts = np.flatnonzero(first)
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    cut = inner[inner > 0] - 1
    last[cut] |= ink[cut]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(t.offs[1:], starts, side="right")


def word_counts(rows_of_words: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Words per row, and the index of each row's first word (with the total at the end)."""
    counts = np.bincount(rows_of_words, minlength=n_rows)
    return counts, np.concatenate(([0], np.cumsum(counts)))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of ``width`` consecutive word hashes at every place where they fit."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = words[:n].copy()
    for k in range(1, width):
        out *= _U(0xD6E8FEB86659FD93)
        out += words[k:k + n]
        out ^= out >> _U(32)
    return mix(out)


def shingle_sets(t: Texts, width: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of each row: (row numbers, hashes), ordered by row, then hash.

    A row with fewer words than ``width`` has its whole word sequence as its one shingle; a row
    without words has none.
    """
    data = LOWER[t.data] if lower else t.data
    starts, ends, row = word_spans(t)
    words = span_hashes(data, starts, ends)
    counts, firsts = word_counts(row, t.rows)
    sh = window_hashes(words, width)
    keep = np.ones(len(sh), dtype=bool)
    if len(sh):
        keep = row[:len(sh)] == row[width - 1:]
    hashes, rows = sh[keep], row[:len(sh)][keep]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        acc = np.zeros(len(short), _U)
        for k in range(width - 1):
            has = counts[short] > k
            acc[has] = mix(acc[has] * _U(0xA24BAED4963EE407) + words[firsts[short[has]] + k] + _U(k + 1))
        hashes = np.concatenate((hashes, acc))
        rows = np.concatenate((rows, short))
    order = np.argsort(hashes)
    order = order[np.argsort(rows[order].astype(np.uint16), kind="stable")]
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def gather_spans(source: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The items of many spans of ``source``, end to end."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    at = np.arange(total, dtype=np.int64)
    at += np.repeat(starts - (ends - lengths), lengths)
    return source[at]


def binary_array(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    """An Arrow binary column over one flat buffer; ``offs`` in bytes."""
    kind = pa.binary() if offs[-1] < (1 << 31) else pa.large_binary()
    offs = np.ascontiguousarray(offs, dtype=np.int32 if kind == pa.binary() else np.int64)
    raw = np.ascontiguousarray(data).view(np.uint8)
    return pa.Array.from_buffers(kind, len(offs) - 1, [None, pa.py_buffer(offs), pa.py_buffer(raw)])


def free_name(name: str, columns) -> str:
    """``name``, lengthened until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which code points start, and the code points."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    byte = data[lead]
    code = byte.astype(np.uint32)
    for extra, low, high, mask in ((1, 0xC0, 0xE0, 0x1F), (2, 0xE0, 0xF0, 0x0F), (3, 0xF0, 0xF8, 0x07)):
        wide = np.flatnonzero((byte >= low) & (byte < high))
        if len(wide):
            value = (byte[wide] & mask).astype(np.uint32)
            for k in range(1, extra + 1):
                value = (value << 6) | (data[lead[wide] + k] & 0x3F)
            code[wide] = value
    return lead, code


def char_counts(data: np.ndarray) -> np.ndarray:
    """Code points that start before each byte position (length + 1 entries)."""
    out = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
