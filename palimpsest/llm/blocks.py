"""Arrow text columns as numpy arrays: bounded blocks, words, lines and their 64-bit hashes.

Everything works on UTF-8 bytes. All separators used here are ASCII, so no multi-byte character is ever cut.
Hashes are the same in every process and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20  # Of text worked on at once: the temporary arrays of a task take some 60 times as much.

_BASE = 0x9E6C63D0876A9A47  # Odd, so that it has an inverse modulo 2**64.
_MASK = (1 << 64) - 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

SPACES = np.zeros(256, bool)  # [\x20\x09-\x0D]
SPACES[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)  # A-Z to a-z, the rest as it is.
LOWER[0x41:0x5B] += 0x20


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most `limit` bytes of text, or one row: (slice, bytes, offsets of its rows).

    Null texts count as empty.
    """
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield batch.slice(first, stop - first), data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    if length not in _powers:
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            table = np.full(length, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers[length] = tuple(tables)
    return _powers[length]


def _long_hash(data: np.ndarray) -> int:
    powers, _ = _power_tables(BLOCK_BYTES + 1)
    total = 0
    for at in range(0, len(data), BLOCK_BYTES):
        part = data[at : at + BLOCK_BYTES].astype(np.uint64) + np.uint64(1)
        total += int((part * powers[: len(part)]).sum(dtype=np.uint64)) * pow(_BASE, at, 1 << 64)
    return total & _MASK


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; starts and ends ascend and spans don't overlap."""
    powers, inverses = _power_tables(BLOCK_BYTES + 1)
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        stop = int(np.searchsorted(ends, base + BLOCK_BYTES, "right"))
        if stop <= first:
            out[first] = _long_hash(data[base : ends[first]])
            first += 1
            continue
        part = data[base : ends[stop - 1]].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers[: len(part)], out=sums[1:])
        begin, end = starts[first:stop] - base, ends[first:stop] - base
        out[first:stop] = (sums[end] - sums[begin]) * inverses[begin]
        first = stop
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in bytes, and the row of each. No word reaches over the end of a row."""
    if not len(data):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)  # A row begins here.
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of lines between \\n in bytes, and the row of each; empty lines are left out."""
    newline = np.zeros(256, bool)
    newline[0x0A] = True
    return word_spans(data, offsets, newline)


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `size` words, and the index of the first word of each; runs stay within a row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0xA24BAED4963EE407) + hashes[k : k + n]
    whole = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return mix(total[whole]), whole


def repeats(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which items have an earlier equal one in their row, and which have any equal one in it."""
    order = np.lexsort((keys, rows))
    same = np.zeros(len(keys), bool)
    if len(keys) > 1:
        same[1:] = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    later, any_equal = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order] = same  # lexsort is stable: the first of equals comes first.
    either = same.copy()
    either[:-1] |= same[1:]
    any_equal[order] = either
    return later, any_equal
