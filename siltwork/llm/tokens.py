"""Distinct byte runs of Arrow text columns, told apart exactly.

Runs are found and hashed over a whole chunk at once (see :mod:`siltwork.llm.words`); runs of one
hash are then compared byte by byte, so a clash of hashes never merges two words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from siltwork.llm import words as W

COMPARED = 1 << 20  # bytes compared at once


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all bytes of the runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def same_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray) -> np.ndarray:
    """Whether each run of ``raw`` has the bytes of the run beside it in ``other``."""
    sizes = ends - starts
    same = sizes == other_ends - other_starts
    total = np.cumsum(sizes)
    at = 0
    while at < len(starts):
        done = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + COMPARED, "right")))
        here = np.flatnonzero(same[at:to]) + at
        differ = raw[_spread(starts[here], sizes[here])] != other[_spread(other_starts[here], sizes[here])]
        if differ.any():
            same[here[np.searchsorted(np.cumsum(sizes[here]), np.flatnonzero(differ), "right")]] = False
        at = to
    return same


def codes_of(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number from 0 for each distinct run, and for each number one run that has it."""
    _, first, codes = np.unique(hashes, return_index=True, return_inverse=True)
    lead = first[codes]
    if same_bytes(raw, starts, ends, raw, starts[lead], ends[lead]).all():
        return codes, first
    seen: dict[bytes, int] = {}
    codes = np.array([seen.setdefault(raw[a:b].tobytes(), len(seen)) for a, b in zip(starts.tolist(), ends.tolist())])
    return codes, np.unique(codes, return_index=True)[1]


def joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: list[np.ndarray]) -> pa.Array:
    """Strings of the runs in ``rows`` (first words, second words, ...), parted by one space."""
    raw = np.append(raw, np.uint8(0x20))
    blank = np.full(len(rows[0]), len(raw) - 1)
    froms, sizes = [], []
    for k, at in enumerate(rows):
        if k:
            froms.append(blank)
            sizes.append(np.ones(len(at), np.int64))
        froms.append(starts[at])
        sizes.append(ends[at] - starts[at])
    lengths = np.sum(sizes, axis=0)
    data = raw[_spread(np.stack(froms, 1).ravel(), np.stack(sizes, 1).ravel())]
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))


def hashes_of(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of lower-cased bytes."""
    return W.run_hashes(W.BYTE_VALUES[lowered], starts, ends)
