"""Columnar text helpers for Arrow batches: UTF-8 buffers, word boundaries,
run boundaries of public split patterns, dictionaries of words.

Texts of a batch lie end to end in one byte array; every helper works on the
whole array at once and never lets a word cross a text's border. A null text
is an empty one.
"""

from __future__ import annotations

import ctypes
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: Unicode White_Space (fixed values).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``max_bytes`` of ``column`` (or
    one row, if that row alone is longer)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to


def freed(step: Callable) -> Callable:
    """The Arrow step ``step``, which at its end gives free memory back to the
    system. A Python worker outlives its tasks, beside the workers of other
    steps; its allocators would keep most of what the largest task took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
        if trim is not None:
            trim(0)

    return run


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; offsets start at 0."""
    kind = pa.large_binary()
    column = pc.fill_null(column.cast(kind), b"")
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: (starts, ends, words before each text)."""
    inside = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    table[WHITE_SPACE] = SPACE
    return table


def classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each byte's character, whether the byte starts one)."""
    table = _classes()
    kind = table[:128][np.minimum(data, 127)]
    lead = np.ones(len(data), bool)
    high = np.flatnonzero(data >= 0x80)
    if len(high):
        b = data[high].astype(np.int64)
        is_lead = b >= 0xC0
        lead[high[~is_lead]] = False
        at, b = high[is_lead], b[is_lead]
        pad = np.concatenate([data, np.zeros(3, np.uint8)])
        c1, c2, c3 = (pad[at + k].astype(np.int64) & 0x3F for k in (1, 2, 3))
        cp = np.where(b < 0xE0, (b & 0x1F) << 6 | c1, np.where(b < 0xF0, (b & 0x0F) << 12 | c1 << 6 | c2, (b & 0x07) << 18 | c1 << 12 | c2 << 6 | c3))
        k = table[np.minimum(cp, 0x10FFFF)]
        size = np.where(b < 0xE0, 2, np.where(b < 0xF0, 3, 4))
        for step in range(4):
            on = size > step
            kind[at[on] + step] = k[on]
    return kind, lead


def _contractions(data: np.ndarray, kind: np.ndarray, at: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the apostrophes ``at`` (each a run of its own), those that begin
    's 't 're 've 'm 'll 'd, and the number of letters that follow."""
    pad = np.concatenate([data, np.zeros(2, np.uint8)]) | 0x20
    edge = np.concatenate([border, np.ones(2, bool)])
    a, b = pad[at + 1], pad[at + 2]
    letter = np.concatenate([kind == LETTER, np.zeros(2, bool)])
    here = letter[at + 1] & ~edge[at + 1]
    two = here & letter[at + 2] & ~edge[at + 2]
    one = here & np.isin(a, np.frombuffer(b"stmd", np.uint8))
    pair = two & (((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l"))))
    n = np.where(one, 1, np.where(pair, 2, 0))
    return at[n > 0], n[n > 0]


def _runs(data, offsets):
    kind, lead = classes(data)
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    first = np.ones(len(data), bool)
    first[1:] = (kind[1:] != kind[:-1]) | border[1:-1]
    return kind, lead, border, first


def split_byte_bpe(data: np.ndarray, offsets: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """Start of every match of the byte-level BPE split pattern
    ('s|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|white space with
    its last character left to a following word). Matches tile the texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind, lead, border, first = _runs(data, offsets)
    begins = np.flatnonzero(first)
    ends = np.append(begins[1:], n)
    of = kind[begins]
    start = np.zeros(n + 3, bool)
    # runs of letters, numbers, others: with a space before them, if one is there
    solid = begins[of != SPACE]
    spaced = (solid > 0) & (data[np.maximum(solid - 1, 0)] == 0x20) & ~border[solid]
    start[solid - spaced] = True
    # white space: all but its last character, then that one unless a space a word has taken
    gap, gap_end = begins[of == SPACE], ends[of == SPACE]
    final = border[gap_end] | (gap_end == n)
    chars = np.flatnonzero(lead)
    last = chars[np.searchsorted(chars, gap_end, "left") - 1]
    start[gap[final | (last > gap)]] = True
    alone = ~final & (data[last] != 0x20)
    start[last[alone]] = True
    # contractions: an apostrophe that starts a match and is a run of one
    quote = begins[(of == OTHER) & (data[begins] == 0x27) & (ends - begins == 1)]
    quote = quote[start[quote]]
    at, size = _contractions(data, kind, quote, border)
    if not fold_case and len(at):
        pad = np.concatenate([data, np.zeros(2, np.uint8)])
        same = (pad[at + 1] >= 0x61) & ((size == 1) | (pad[at + 2] >= 0x61))
        at, size = at[same], size[same]
    start[at + 1] = False
    rest = at + 1 + size
    inside = rest < n
    rest = rest[inside]
    more = (kind[rest] == LETTER) & ~border[rest]
    start[rest[more]] = True
    return np.flatnonzero(start[:n])


def split_word_bpe(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the matches of 's|'t|'re|'ve|'m|'ll|'d|letters|
    one number|others, upper case letters read as lower; white space is left
    out."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind, lead, border, first = _runs(data, offsets)
    begins = np.flatnonzero(first)
    ends = np.append(begins[1:], n)
    of = kind[begins]
    start = np.zeros(n + 3, bool)
    start[begins] = True
    start[:n] |= lead & (kind == NUMBER)
    quote = begins[(of == OTHER) & (data[begins] == 0x27) & (ends - begins == 1)]
    at, size = _contractions(data, kind, quote, border)
    start[at + 1] = False
    rest = at + 1 + size
    rest = rest[rest < n]
    start[rest[(kind[rest] == LETTER) & ~border[rest]]] = True
    starts = np.flatnonzero(start[:n])
    ends = np.append(starts[1:], n)
    solid = kind[starts] != SPACE
    return starts[solid], ends[solid]


def dictionary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(index of each piece, distinct pieces as binary) of tiling or
    separated pieces ``data[starts:ends]``."""
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.large_binary())
    if len(starts) > 1 and not np.array_equal(starts[1:], ends[:-1]):
        sizes = ends - starts
        keep = np.zeros(len(data) + 1, np.int8)
        keep[starts] += 1
        keep[ends] -= 1
        data = data[np.cumsum(keep[:-1], dtype=np.int8).view(bool)]
        at = np.concatenate([[0], np.cumsum(sizes)])
    else:
        at = np.append(starts, ends[-1]) - starts[0]
        data = data[starts[0] : ends[-1]]
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = pieces.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def gather(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the ranges ``values[offsets[i]:offsets[i+1]]`` for
    every i of ``index``, and where each begins."""
    sizes = (offsets[1:] - offsets[:-1])[index]
    at = np.concatenate([[0], np.cumsum(sizes)])
    step = np.ones(at[-1], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return values[:0], at
    begin = offsets[:-1][index[full]]
    step[0] = begin[0]
    step[at[full[1:]]] = begin[1:] - (begin[:-1] + sizes[full[:-1]] - 1)
    return values[np.cumsum(step)], at
