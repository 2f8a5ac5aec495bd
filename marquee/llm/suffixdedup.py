"""Removal of repeated byte strings by expanding intervals on a Burrows-Wheeler transform.

For the segments that ``routing`` brings together, rows of the transform are in the order of what follows them.
An interval of rows stands for a string; extending the string backwards by a byte gives the intervals of longer
strings. They are expanded breadth first, by increasing length: an interval of length n whose end is still an
open border between rows fixes the common prefix there to n and is expanded further, all others are left. After
the length ``window - 1``, the borders still open are those whose rows share ``window`` bytes or more.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import routing
from .common import id_and_text

#: Ends each segment; no byte of UTF-8.
END = 0xFF


def open_borders(text: np.ndarray, order: np.ndarray, room: np.ndarray, window: int) -> np.ndarray:
    """True at row r if rows r - 1 and r share ``window`` bytes. ``room``: bytes up to the end of the segment."""
    n = len(text)
    before = text[order - 1]
    before[order == 0] = END
    step = np.empty(n, np.int64)
    step[np.argsort(before, kind="stable")] = np.arange(n)
    # Equal bytes that stand together in the transform move together.
    starts = np.concatenate([[0], np.flatnonzero(before[1:] != before[:-1]) + 1])
    ends = np.append(starts[1:], n)
    run = np.repeat(np.arange(len(starts)), ends - starts)
    byte, base = before[starts].astype(np.int64), step[starts] - starts

    fixed = np.zeros(n + 1, bool)
    fixed[[0, n]] = True
    # Common prefixes below eight bytes are read off the first eight, those of seven start the expansion.
    eight = _eight(text)[order]
    differ = eight[1:] ^ eight[:-1]
    at = np.flatnonzero(differ) + 1
    fixed[at] = True
    right = at[differ[at - 1] < 256]
    left = np.concatenate([[0], at])[np.searchsorted(at, right)]
    keep = room[order[left]] >= 8
    left, right = left[keep], right[keep]
    for _ in range(8, window):
        if not len(left):
            break
        a, b = run[left], run[right - 1]
        many = b - a + 1
        owner = np.repeat(np.arange(len(left)), many)
        piece = a[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        c = byte[piece]
        low = np.maximum(left[owner], starts[piece]) + base[piece]
        high = np.minimum(right[owner], ends[piece]) + base[piece]
        if len(owner) > len(left):  # pieces of one byte in one interval: from the first to the last
            key = owner * 256 + c
            by = np.argsort(key, kind="stable")
            key, low, high, c = key[by], low[by], high[by], c[by]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            last = np.append(first[1:], True)
            low, high, c = low[first], high[last], c[first]
        fresh = (c != END) & ~fixed[high]
        left, right = low[fresh], high[fresh]
        fixed[right] = True
    full = room[order] >= window
    out = np.zeros(n + 1, bool)
    out[1:n] = ~fixed[1:n] & full[1:] & full[:-1]
    return out


def _eight(text: np.ndarray) -> np.ndarray:
    raw = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((len(text),), ">u8", raw, strides=(1,)).astype(np.uint64)


def repeated_windows(segments: list[np.ndarray], weights: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """Spans under windows that start at two places of the segments at least; a segment of weight 2 counts twice."""
    end = np.array([END], np.uint8)
    text = np.concatenate([x for s in segments for x in (s, end)])
    sizes = np.array([len(s) + 1 for s in segments])
    first = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(segments)), sizes)
    room = (first + sizes - 1)[owner] - np.arange(len(text))
    order = routing.suffix_order(_eight(text), 8, window)
    borders = open_borders(text, order, room, window)
    again = borders[:-1] | borders[1:] | ((weights[owner[order]] > 1) & (room[order] >= window))
    flags = np.zeros(len(text), bool)
    flags[order[again]] = True
    spans: list[list[tuple[int, int]]] = [[] for _ in segments]
    for a, b in zip(*(x.tolist() for x in routing.runs_of(flags))):
        i = int(owner[a])
        spans[i].append((a - int(first[i]), b - int(first[i]) + window - 1))
    return spans


def remove_repeats(docs: DataFrame, window: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` for every row: the text as UTF-8 without the bytes
    covered by a ``window``-byte string that also starts anywhere else, in this or another row.

    Null and empty texts are kept as no bytes; repeated rows are each other's repeats, so texts of at least
    ``window`` bytes in them go whole; texts shorter than that stay; extra columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col)
    spans = routing.repeated(rows, window, routing.Bytes, repeated_windows, chunk=2 << 20)

    def work(text: bytes, cut: list[tuple[int, int]]) -> tuple:
        edges = [0, *(x for s in cut for x in s), len(text)]
        kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
        return len(text), len(text) - len(kept), len(cut), kept

    return routing.apply_spans(rows, spans, work, "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
