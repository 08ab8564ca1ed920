"""Words and word shingles of whole Arrow columns as numpy arrays.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased. A word's
hash is a polynomial of its bytes modulo 2**64, mixed; a shingle's, one of its words'.
Texts are worked on in pieces of bounded size, whatever the batch; a single text
larger than that is cut at white space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = _U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, dtype=_U)
            p[0] = 1
            p = np.multiply.accumulate(p)
            if len(_powers) > i:
                _powers[i] = p
            else:
                _powers.append(p)
    return _powers[0], _powers[1]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1) of a string column, without copying; nulls are empty."""
    if pa.types.is_string(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_string()), np.int64
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


@dataclass
class Words:
    """Words of consecutive texts: bytes, start and end of each word in them, its hash;
    first[i]: the first word of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end, first of the words of the texts data[at[i]:at[i + 1]]."""
    low, high = int(at[0]), int(at[-1])
    word = ~_SPACE[data[low:high]]
    edge = np.zeros(len(word) + 1, bool)
    edge[at - low] = True
    before = np.empty(len(word), bool)
    before[:1] = False
    before[1:] = word[:-1]
    start = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(len(word), bool)
    after[-1:] = False
    after[:-1] = word[1:]
    end = np.flatnonzero(word & (~after | edge[1:])) + 1
    return start + low, end + low, np.searchsorted(start + low, at)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the lower-cased bytes of spans within one piece of data."""
    if not len(start):
        return np.zeros(0, _U)
    low, high = int(start[0]), int(end.max())
    up, down = _pow(high - low + 1)
    sums = np.zeros(high - low + 1, _U)
    np.cumsum((_LOWER[data[low:high]].astype(_U) + _U(1)) * up[: high - low], out=sums[1:])
    h = (sums[end - low] - sums[start - low]) * down[start - low]
    return mix64(h + (end - start).astype(_U) * _STEP)


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of ``size`` bytes; a larger row alone."""
    data, at = flat(column)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, side="right")) - 1)
        yield row, data, at[row : end + 1]
        row = end


def words(data: np.ndarray, at: np.ndarray) -> Words:
    start, end, first = word_spans(data, at)
    if len(start) and end[-1] - start[0] > 4 * PIECE:
        cuts = np.searchsorted(start, np.arange(start[0], end[-1], PIECE))
        cuts = np.unique(np.append(cuts, len(start)))
        h = np.concatenate([span_hashes(data, start[a:b], end[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    else:
        h = span_hashes(data, start, end)
    return Words(data, start, end, h, first)


def shingles(h: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): of each text its shingles in order, one of all its words if
    they are fewer than ``width``, none if it has no word."""
    count = np.diff(first)
    n = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    at = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros(int(at[-1]), _U)
    full = count >= width
    if full.any():
        lead = np.zeros(len(h) + 1, np.int64)  # which words begin a shingle
        np.add.at(lead, first[:-1][full], 1)
        np.add.at(lead, first[1:][full] - width + 1, -1)
        begin = np.flatnonzero(np.cumsum(lead[:-1]))
        acc = h[begin].copy()
        for k in range(1, width):
            acc = acc * _STEP + h[begin + k]
        rows = np.repeat(np.flatnonzero(full), n[full])
        place = at[:-1][rows] + (begin - first[:-1][rows])
        out[place] = mix64(acc)
    for i in np.flatnonzero(~full & (count > 0)):
        acc = _U(count[i])
        with np.errstate(over="ignore"):
            for x in h[first[i] : first[i + 1]]:
                acc = acc * _STEP + x
        out[at[i]] = mix64(np.array([acc]))[0]
    return out, at


def shingle_pieces(column: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingle hashes, offsets) of runs of rows."""
    for row, data, at in pieces(column):
        w = words(data, at)
        yield row, *shingles(w.hash, w.first, width)
