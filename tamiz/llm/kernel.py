"""Vectorised hashing of words and lines over the raw bytes of an Arrow string array.

One pass of numpy over the concatenated UTF-8 bytes of many rows replaces per-word Python. A token's
hash is a polynomial over random byte values modulo 2**64, taken as a difference of prefix sums, and
then mixed; it depends on the token's bytes alone, never on its place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 64, 256, dtype=np.uint64, endpoint=False)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes as they are, and with A-Z as a-z.
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32

#: Word bytes for words split at ASCII white space, and for lines.
BLANK = np.ones(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LINE = np.ones(256, bool)
LINE[0x0A] = False


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            out = np.ones(1, np.uint64)
            step = b
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(step)])
                step = step * step & 0xFFFFFFFFFFFFFFFF
            _powers[k] = out
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its n + 1 offsets into them; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    n, at = len(array), array.offset
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if n else np.zeros(0, np.uint8)
    return data, offsets - (offsets[0] if n else 0)


def tokens(data: np.ndarray, offsets: np.ndarray, word: np.ndarray, fold: np.ndarray = SAME) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the maximal runs of ``word`` bytes, the first byte of each run, and for each row
    the number of runs before it (n + 1 values). A run never goes past its row."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return _spans(data, starts, stops, fold), starts, np.searchsorted(starts, offsets)


def _spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, fold: np.ndarray) -> np.ndarray:
    power, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[fold][data] * power[: len(data)], out=total[1:])
    sums = (total[stops] - total[starts]) * inverse[starts]
    return mix(sums ^ ((stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes and ends of all lines (empty ones too), and the number of lines before each row.
    A row has one line more than it has line feeds; an empty row has one line."""
    feeds = np.flatnonzero(data == 0x0A)
    rows = len(offsets) - 1
    starts = np.concatenate([offsets[:-1], feeds + 1])
    stops = np.concatenate([offsets[1:], feeds])
    owner = np.concatenate([np.arange(rows), np.searchsorted(offsets, feeds, side="right") - 1])
    starts = starts[np.lexsort((starts, owner))]
    stops = stops[np.lexsort((stops, owner))]
    return starts, stops, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all lines, and their spans."""
    starts, stops, before = line_spans(data, offsets)
    return _spans(data, starts, stops, SAME), starts, stops, before


def _orders(data: np.ndarray, first: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 32-bit number of each word, which SQL has too: of its first four bytes (zeros after them), its last four (zeros before them) and its size."""
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint64)
    four = padded[:-3] << np.uint64(24) | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(8) | padded[3:]
    size = stops - first
    short = (8 * np.maximum(0, 4 - size)).astype(np.uint64)
    low = four[first] >> short
    high = np.where(size < 4, low, four[np.maximum(stops - 4, 0)])
    mixed = (low << short) * np.uint64(2654435761) + high * np.uint64(2246822519) + size.astype(np.uint64) * np.uint64(97)
    return (mixed & np.uint64(0xFFFFFFFF)).astype(np.int64)


def wrapped_lines(data: np.ndarray, offsets: np.ndarray, words: int, around: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines, of which those of more than ``words`` words are wrapped after the words that are least among the ``around`` words
    before them (strictly) and after them, so that cuts depend on the words nearby alone: hashes, first bytes, ends, the
    number of the line each is of, and the number of wrapped lines before each row. Blanks stay with the word before
    them, those at a line's beginning with its first word."""
    starts, stops, lines = line_spans(data, offsets)
    inside = BLANK[data]
    new_row = np.bincount(offsets[:-1][offsets[:-1] < len(data)], minlength=len(data)) > 0
    begun = inside.copy()
    begun[1:] &= ~inside[:-1] | new_row[1:]
    ended = inside.copy()
    ended[:-1] &= ~inside[1:] | new_row[1:]
    first, last = np.flatnonzero(begun), np.flatnonzero(ended) + 1
    owner = np.searchsorted(starts, first, side="right") - 1
    many = np.bincount(owner, minlength=len(starts))[owner] > words
    first, last, owner = first[many], last[many], owner[many]
    number = _orders(data, first, last)
    cut = np.ones(len(first), bool)
    for k in range(1, around + 1):
        if k < len(first):
            same = owner[k:] == owner[:-k]
            cut[k:] &= ~same | (number[k:] < number[:-k])
            cut[:-k] &= ~same | (number[:-k] <= number[k:])
    # The word after a cut begins a wrapped line.
    after = np.flatnonzero(cut[:-1] & (owner[1:] == owner[:-1])) + 1 if len(first) else np.zeros(0, np.int64)
    line = np.concatenate([np.arange(len(starts)), owner[after]])
    begins = np.concatenate([starts, first[after]])
    order = np.lexsort((begins, line))
    line, begins = line[order], begins[order]
    ends = stops[line]
    more = np.flatnonzero(line[1:] == line[:-1])
    ends[more] = begins[more + 1]
    return _spans(data, begins, ends, SAME), begins, ends, line, np.searchsorted(line, lines)


def runs_of(hashes: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive tokens at each place, and whether the place is a start: all k tokens
    are of one row; a row with fewer tokens (not none) has one start, whose hash is of them all."""
    n = len(hashes)
    counts = np.diff(before)
    left = np.repeat(before[1:], counts) - np.arange(n)
    out = np.zeros(n, np.uint64)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    for j in range(k):
        part = padded[j : j + n].copy()
        part[left <= j] = 0
        out = out * np.uint64(0xA24BAED4963EE407) + part
    ok = left >= k
    short = before[:-1][(counts > 0) & (counts < k)]
    ok[short] = True
    return mix(out ^ np.minimum(left, k).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), ok
