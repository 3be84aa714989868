"""64-bit hashes of the words of many texts at once, in numpy.

Words are runs of anything but space and tab to carriage return, taken from the UTF-8
bytes as they lie in an Arrow column, without a Python string per document or word. A
word's hash is a polynomial over a random table of bytes, modulo 2^64, mixed at the end;
two different words or shingles are taken for equal with a probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes handled at a time within a batch: small enough for the processor's caches.
PIECE = 1 << 18
# Texts whose words are held at a time, in bytes of text; a longer text is alone.
GROUP = 1 << 22


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    step = base
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * np.uint64(step)
        done += take
        step = step * step % (1 << 64)
    return out


BASE = 0x9E3779B97F4A7C15
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_LOWER = _BYTES.copy()
_LOWER[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_UP = _powers(BASE, PIECE + 1)
_DOWN = _powers(pow(BASE, -1, 1 << 64), PIECE + 1)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """Hashes of data[start:end]; spans in order, without overlap, all within one piece."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _BYTES)[data] * up[: len(data)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse."""
    global _UP, _DOWN
    if n > len(_UP):
        _UP, _DOWN = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
    return _UP, _DOWN


class Words:
    """Words of some texts: row, start and end within `data`, hash, and each row's range of words."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool):
        """bounds: where each text starts in `data`, and the end of the last."""
        starts, ends, hashes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        at = 0
        while at < len(data):
            to = min(at + PIECE, len(data))
            space = _IS_SPACE[data[at:to]]
            if to < len(data) and not _IS_SPACE[data[to]] and not _is_bound(bounds, to):
                to = _cut_before(data, bounds, space, at, to)
                space = _IS_SPACE[data[at:to]]
            inside = ~space
            cuts = bounds[(bounds > at) & (bounds < to)] - at
            first, last = inside.copy(), inside.copy()
            first[1:] &= space[:-1]
            last[:-1] &= space[1:]
            first[cuts] = inside[cuts]
            last[cuts - 1] = inside[cuts - 1]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            hashes.append(hash_spans(data[at:to], s, e, lower))
            starts.append(s + at)
            ends.append(e + at)
            at = to
        self.start, self.end, self.hash = np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)
        self.data = data
        self.first = np.searchsorted(self.start, bounds)  # of each row; one more at the end
        self.row = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first))


def _is_bound(bounds: np.ndarray, at: int) -> bool:
    i = np.searchsorted(bounds, at)
    return i < len(bounds) and bounds[i] == at


def _cut_before(data: np.ndarray, bounds: np.ndarray, space: np.ndarray, at: int, to: int) -> int:
    """Where to end the piece so that no word is cut: behind the last space or text, or past a word longer than the piece."""
    spaces = np.flatnonzero(space)
    i = np.searchsorted(bounds, to) - 1
    found = max(at + spaces[-1] + 1 if len(spaces) else at, int(bounds[i]) if i >= 0 else at)
    if found > at:
        return int(found)
    while to < len(data):
        ahead = np.flatnonzero(_IS_SPACE[data[to : to + PIECE]])
        limit = int(bounds[np.searchsorted(bounds, to)])
        if len(ahead):
            return min(to + int(ahead[0]), limit)
        if limit <= to + PIECE:
            return limit
        to += PIECE
    return len(data)


def text_groups(column: pa.Array, group: int = GROUP) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, bounds) of runs of texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, np.uint8)
    if column.null_count:  # a null may still span bytes
        nulls = np.asarray(column.is_null())
        if np.any(np.diff(offsets)[nulls]):
            yield from text_groups(pa.array([b"" if x is None else x for x in column.to_pylist()], pa.large_binary()), group)
            return
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + group, side="right")) - 1)
        to = min(to, len(column))
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to


def word_groups(column: pa.Array, lower: bool = False, group: int = GROUP) -> Iterator[tuple[int, int, Words]]:
    for row, to, data, bounds in text_groups(column, group):
        yield row, to, Words(data, bounds, lower)


_ODD = mixed(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words each; one fewer than k shorter than the input. Rows are not told apart."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out += hashes[i : i + n] * _ODD[i]
    return mixed(out)
