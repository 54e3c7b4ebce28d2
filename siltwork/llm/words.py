"""Words and shingles of Arrow text columns as numpy arrays.

A batch of texts is one run of UTF-8 bytes with offsets, and all work is done on
those bytes at once: no Python object per word.  Words are maximal runs of
bytes other than space and tab to carriage return, ASCII letters count in lower
case, and words are known by 64-bit hashes.  Memory is about 40 bytes per byte
of a chunk of ``CHUNK`` bytes, or of the longest single text beyond that.

Null texts have no words, like empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
STEP = np.uint64(0xD6E8FEB86659FD93)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: each bit of the result depends on all bits of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(count: int, salt: int) -> np.ndarray:
    """Fixed odd 64-bit numbers."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(BASE) + np.uint64(salt)) | np.uint64(1)


BYTE_VALUES = seeds(256, 7)[LOWER]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and its inverses modulo 2**64 for i below ``count``; those of a chunk are kept."""
    if len(_powers[0]) < count:
        size = max(count, CHUNK)
        made = []
        for factor in (BASE, pow(BASE, -1, 1 << 64)):
            run = np.full(size, factor, np.uint64)
            run[0] = 1
            made.append(np.multiply.accumulate(run))
        if size > 4 * CHUNK:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes, and row offsets into them, for runs of rows of about ``CHUNK`` bytes."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, data = texts.buffers()
    rows = len(texts)
    if not rows:
        return
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + rows + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        yield row, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """Words of consecutive rows: word ``i`` of row ``r`` stands at ``first[r] + i``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first run of each row for the runs of true bytes; rows part runs."""
    size = len(inside)
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < size)]
    opens[edges] = inside[edges]
    starts = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    closes[edges - 1] = inside[edges - 1]
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs, from one running sum over per-byte values."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(values))
    total = np.cumsum(values * up[: len(values)], dtype=np.uint64)
    before = np.where(starts > 0, total[np.maximum(starts, 1) - 1], np.uint64(0))
    inner = (total[ends - 1] - before) * down[starts]
    return mix(inner + (ends - starts).astype(np.uint64) * STEP)


def words(raw: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends, first = runs(~SPACE[raw], offsets)
    return Words(starts, ends, first, run_hashes(BYTE_VALUES[raw], starts, ends))


def shingles(found: Words, width: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of each run of ``width`` words, in row and place order.

    With ``short``, a row of fewer words has its whole sequence as one shingle.
    """
    h, counts = found.hashes, found.counts
    rows = found.rows
    size = max(len(h) - width + 1, 0)
    whole = rows[:size] == rows[width - 1 :] if size else np.zeros(0, bool)
    made = np.full(size, width, np.uint64)
    for k in range(width):
        made = made * STEP + h[k : size + k]
    at = np.flatnonzero(whole)
    out_rows, places, out = rows[at], at - found.first[rows[at]], mix(made[at])
    if short:
        for length in range(1, width):
            few = np.flatnonzero(counts == length)
            if len(few):
                made = np.full(len(few), length, np.uint64)
                for k in range(length):
                    made = made * STEP + h[found.first[few] + k]
                out_rows = np.concatenate([out_rows, few])
                places = np.concatenate([places, np.zeros(len(few), np.int64)])
                out = np.concatenate([out, mix(made)])
        order = np.argsort(out_rows, kind="stable")
        out_rows, places, out = out_rows[order], places[order], out[order]
    return out_rows, places, out


def shingle_sets(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, and the offsets of the rows."""
    rows, _, out = shingles(found, width)
    count = len(found.first) - 1
    bounds = np.searchsorted(rows, np.arange(count + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (rows[1:] != rows[:-1])
    out = out[keep]
    return out, np.searchsorted(rows[keep], np.arange(count + 1))


LETTER = np.zeros(256, bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def lowered(raw: np.ndarray) -> np.ndarray:
    """Bytes in lower case: ASCII, and the Latin letters that UTF-8 writes with 0xC3."""
    out = LOWER[raw]
    after = np.flatnonzero(raw[:-1] == 0xC3) + 1
    low = raw[after]
    out[after] = low + np.where((low >= 0x80) & (low <= 0x9E) & (low != 0x97), np.uint8(0x20), np.uint8(0))
    return out


PLAIN_VALUES = seeds(256, 7)


def letter_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Runs of letters (all bytes beyond ASCII count as such), and the per-byte values of their hashes."""
    starts, ends, first = runs(LETTER[raw], offsets)
    values = PLAIN_VALUES[lowered(raw)]
    return Words(starts, ends, first, run_hashes(values, starts, ends)), values
