"""Word hashes of Arrow texts, computed on whole buffers.

A word's hash is a Karp-Rabin sum of random byte values over its bytes, taken from one running sum over the
buffer, and mixed. Nothing depends on the process, the machine or the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; a longer word is hashed in one piece all the same.
BLOCK = 1 << 20

_SEED = 20240229
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes of plain words: letters, digits and everything beyond ASCII.
PLAIN = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _lower_values() -> np.ndarray:
    values = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


VALUES = _lower_values()


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < size:
        for slot, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(max(size, BLOCK), base & _MASK, np.uint64)
            table[0] = 1
            _powers[slot] = np.cumprod(table, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; nulls count as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    start, stop = int(at[0]), int(at[-1])
    return (np.frombuffer(data, np.uint8)[start:stop] if stop > start else np.zeros(0, np.uint8)), at - start


def line_offsets(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r"""Offsets of the \n-split lines of all rows, and the number of lines before each row.

    A line's \n belongs to the line before it; an empty text has one empty line.
    """
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.sort(np.concatenate([rows[:-1], breaks]), kind="stable")
    counts = np.searchsorted(breaks, rows[1:], "right") - np.searchsorted(breaks, rows[:-1], "right")
    first = np.concatenate([[0], np.cumsum(counts + 1)])
    # a break at the end of a row starts that row's last, empty line
    return np.concatenate([starts, rows[-1:]]), first


def hash_words(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (runs of bytes that are ``inside``) of consecutive segments, ASCII letters lower-cased.

    Returns the hashes, the number of words before each segment, and the words' first and past-the-end bytes.
    """
    size = len(data)
    hashes, firsts, lasts = [], [], []
    cuts = np.unique(offsets[(offsets > 0) & (offsets < size)])
    begin = 0
    while begin < size:
        stop = min(size, begin + BLOCK)
        if stop < size and inside[data[stop]] and inside[data[stop - 1]]:
            back = np.flatnonzero(~inside[data[begin:stop]])
            if len(back):
                stop = begin + int(back[-1]) + 1
            else:
                step = BLOCK
                while stop < size:
                    ahead = np.flatnonzero(~inside[data[stop : stop + step]])
                    if len(ahead):
                        stop += int(ahead[0])
                        break
                    stop = min(size, stop + step)
        chunk = data[begin:stop]
        word = inside[chunk]
        start, end = word.copy(), word.copy()
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        here = cuts[np.searchsorted(cuts, begin, "right") : np.searchsorted(cuts, stop)] - begin
        start[here] = word[here]
        end[here - 1] = word[here - 1]
        a, b = np.flatnonzero(start), np.flatnonzero(end)
        power, inverse = _tables(len(chunk))
        value = VALUES[chunk] * power[: len(chunk)]
        total = np.cumsum(value, dtype=np.uint64)
        hashes.append(mix((total[b] - total[a] + value[a]) * inverse[a]))
        firsts.append(a + begin)
        lasts.append(b + begin + 1)
        begin = stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    first = join(firsts, np.int64)
    return join(hashes, np.uint64), np.searchsorted(first, offsets), first, join(lasts, np.int64)


_WINDOW = np.random.default_rng(_SEED + 1).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def windows(hashes: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words that stay inside a segment, and the word each one starts at."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = hashes[:count] * _WINDOW[0]
    for j in range(1, width):
        total = total + hashes[j : j + count] * _WINDOW[j % 64]
    keep = np.ones(count, bool)
    for j in range(1, width):  # windows that would cross into the next segment
        crossing = before[1:-1] - j
        keep[crossing[(crossing >= 0) & (crossing < count)]] = False
    at = np.flatnonzero(keep)
    return mix(total[at] + np.uint64(width)), at


def sequence_hash(hashes: np.ndarray) -> int:
    """One hash for a whole sequence of words."""
    out = np.array([len(hashes)], np.uint64)
    for h in hashes:
        out = mix(out * np.uint64(_BASE & _MASK) + h)
    return int(out[0])


def slices(batch: pa.RecordBatch, text: int, limit: int = 2 << 20):
    """Consecutive parts of a batch with at most ``limit`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // limit
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(starts, np.append(starts[1:], batch.num_rows), strict=True):
        yield batch.slice(a, b - a)


def segment_hashes(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """One hash per segment for its whole sequence of words; segments without words get the mix of zero."""
    power, inverse = _tables(len(hashes) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power[: len(hashes)], dtype=np.uint64)])
    counts = np.diff(before).astype(np.uint64)
    return mix((total[before[1:]] - total[before[:-1]]) * inverse[before[:-1]] + counts)
