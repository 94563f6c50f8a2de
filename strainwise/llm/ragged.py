"""Helpers for ragged arrays (a flat array plus lengths), used inside Arrow tasks, and for names of helper columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    """Start of every segment, plus the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Flat positions of the segments ``[start, start + length)``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets_of(lengths).astype(np.int32)), pa.array(values))


def chunks(texts: list[str], budget: int) -> Iterator[list[str]]:
    """Consecutive texts of about ``budget`` characters together; a longer text is a chunk of its own, never cut."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > budget:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column is called so (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class Arena:
    """Ragged rows that are appended in blocks and read by row number."""

    def __init__(self, dtype):
        self.flat = np.empty(1 << 12, dtype)
        self.starts = np.zeros(1 << 10, np.int64)
        self.lengths = np.zeros(1 << 10, np.int64)
        self.rows = 0
        self.used = 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        rows, used = self.rows + len(lengths), self.used + len(values)
        while used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while rows > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.flat[self.used:used] = values
        self.lengths[self.rows:rows] = lengths
        self.starts[self.rows:rows] = self.used + offsets_of(lengths)[:-1]
        self.rows, self.used = rows, used

    def read(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the rows one after the other, and the rows' lengths."""
        lengths = self.lengths[rows]
        return self.flat[gather(self.starts[rows], lengths)], lengths
