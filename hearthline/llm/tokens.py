"""Words, shingles and lines of many texts at once, as numpy arrays inside Arrow tasks.

Texts come as Arrow string columns; their UTF-8 buffers are read in place. A word is
a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return. Work goes through pieces of about a megabyte of whole texts, so memory follows
the longest single text (some 60 bytes for each of its bytes), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_CODES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)


class Piece(NamedTuple):
    """Some neighbouring texts: row numbers ``first`` and up, their bytes, and where each begins."""

    first: int
    data: np.ndarray
    starts: np.ndarray  # one more than there are texts

    @property
    def rows(self) -> int:
        return len(self.starts) - 1


class Spans(NamedTuple):
    """Runs of bytes: where they begin and end, and how many belong to the texts before each text."""

    begin: np.ndarray
    end: np.ndarray
    offsets: np.ndarray

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut a string column into pieces of whole texts; a null is an empty text."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if not len(column):
        return
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.null_count:  # what lies below a null is undefined
        column = column.fill_null("")
        _, offsets, data = column.buffers()
        starts = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(starts, starts[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Piece(first, raw[starts[first] : starts[last]], starts[first : last + 1] - starts[first])
        first = last


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def row(base):
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return row(_ODD), row(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes, wherever it stands."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    power, inverse = _powers(1 << max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def words(piece: Piece) -> Spans:
    """The words of a piece's texts."""
    space = IS_SPACE[piece.data]
    before = np.empty(len(space) + 1, bool)
    before[0] = True
    before[1:] = space
    before[piece.starts] = True
    begin = np.flatnonzero(~space & before[:-1])
    end = np.flatnonzero(~space & before_end(space, piece.starts)) + 1
    return Spans(begin, end, np.searchsorted(begin, piece.starts))


def before_end(space: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a space or the end of a text follows each byte."""
    after = np.ones(len(space), bool)
    after[:-1] = space[1:]
    after[starts[starts > 0] - 1] = True
    return after


def lines(piece: Piece) -> Spans:
    """The lines of a piece's texts, split at line feeds only."""
    feeds = np.flatnonzero(piece.data == 10)
    begin = np.sort(np.concatenate([piece.starts[:-1], feeds + 1]))
    end = np.sort(np.concatenate([piece.starts[1:], feeds]))
    per_text = 1 + np.searchsorted(feeds, piece.starts[1:]) - np.searchsorted(feeds, piece.starts[:-1])
    return Spans(begin, end, np.concatenate([[0], np.cumsum(per_text)]))


def shingles(hashes: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct word shingles, sorted, and their offsets.

    A text of fewer words has its whole sequence as one shingle, one without words none.
    """
    counts = np.diff(offsets)
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    odd = 0xD1342543DE82EF95
    for k in range(size):
        rolled[: max(0, n - k)] += hashes[k:] * np.uint64(pow(odd, k, 1 << 64))
    owner = np.repeat(np.arange(len(counts)), counts)
    left = offsets[1:][owner] - np.arange(n) if n else np.zeros(0, np.int64)
    full = left >= size
    value, row = mix(rolled[full]), owner[full]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = []
        for i in short:
            h = int(counts[i])
            for x in hashes[offsets[i] : offsets[i + 1]].tolist():
                h = (h * odd + x) & (1 << 64) - 1
            whole.append(h)
        value = np.concatenate([value, mix(np.array(whole, np.uint64))])
        row = np.concatenate([row, short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    if len(value):
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
        value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(counts) + 1))
