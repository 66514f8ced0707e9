"""Whole texts as numpy byte arrays inside tasks: words, rolling hashes, sliding minima.

All hashes are 64-bit, computed without a loop over bytes: with prefix sums
P[i] = sum((b_j + 1) * B^j) the slice [s, e) has the hash (P[e] - P[s]) * B^-s.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

#: Bytes that part words: space and the controls 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: ASCII capitals to small letters, everything else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _power(name: str, base: int, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        size = max(n, 1 << 16, 2 * len(known) if known is not None else 0)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        known = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte slice; equal slices have equal hashes wherever they stand."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, n), dtype=np.uint64, out=sums[1:])
    down = _power("down", _INVERSE, n + 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of `size` bytes, by start."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    starts = np.arange(n)
    return slice_hashes(data, starts, starts + size)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in one text's bytes."""
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~SPACE[data]
    turn = np.diff(word)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of each lower-cased word of one text, in order."""
    starts, ends = word_spans(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    return slice_hashes(LOWER[data], starts, ends)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every run of `size` words, by first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + words[i : i + n])
    return total


def shingle_set(data: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of word runs; fewer words than `size` count as one run; no words, none."""
    words = word_hashes(data)
    if not len(words):
        return words
    return np.unique(run_hashes(words, min(size, len(words))))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of every window of `width` keys: block prefixes and suffixes, linear time."""
    n = len(keys) - width + 1
    if n <= 0:
        return keys[:0]
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def minimizers(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of the least hash (leftmost of equals) over every window, with the first and last
    window it stands for. Equal windows choose the same place, wherever they are."""
    high = hashes & np.uint64(0xFFFFFFFF00000000)
    least = sliding_least(high | np.arange(len(hashes), dtype=np.uint64), width)
    if not len(least):
        none = np.zeros(0, np.int64)
        return none, none, none
    firsts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    lasts = np.append(firsts[1:], len(least)) - 1
    return (least[firsts] & np.uint64(0xFFFFFFFF)).astype(np.int64), firsts, lasts


def column_bytes(column: pa.Array) -> Iterator[np.ndarray]:
    """Each value of a string or binary column as bytes; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column, pa.scalar(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "", column.type))
    _, places, content = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    for i in range(len(column)):
        yield data[offsets[i] : offsets[i + 1]]


def runs_of_keys(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole key groups from batches sorted by key; several small groups may share a table.

    A table ends where a group ends. Only the unfinished last group is carried over.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        if held and any(held[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        if not len(starts):
            held.append(batch)
            continue
        cut = int(starts[-1])
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each key group in a table sorted by key, and the row count at the end."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)
