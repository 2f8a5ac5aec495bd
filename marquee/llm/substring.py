"""Removal of repeated word sequences by matching statistics over compressed FM-indexes.

``routing`` deals segments of words out to shards. Each shard indexes its distinct segments: the
Burrows-Wheeler transform of their words is held as a wavelet matrix of packed bits, one per bit of a word's
number, with counts every 64 bits. All segments are then streamed through the index from right to left, many side by
side: backward search extends each match while the interval of rows still stands for two places or more. Where it
no longer does, the longest match that ends there is known; matches of ``window`` words or more are reported and
the search resumes at the last end that a window not yet decided can have.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from . import routing
from .common import id_and_text


class FMIndex:
    """Backward search over sequences of numbers; 0 ends each sequence."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        wide = text.astype(np.int64)
        pad = np.concatenate([wide, np.zeros(2, np.int64)])
        order = routing.suffix_order((pad[:n] << 42) | (pad[1 : n + 1] << 21) | pad[2 : n + 2], 3, depth)
        self.order = order
        last = wide[order - 1]
        last[order == 0] = 0
        top = int(wide.max())
        self.below = np.concatenate([[0], np.cumsum(np.bincount(wide, minlength=top + 1))])
        self.levels = []
        shape = -(-(n + 1) // 64)
        for bit in range(top.bit_length() - 1, -1, -1):
            ones = (last >> bit) & 1 == 1
            packed = np.packbits(np.concatenate([ones, np.zeros(shape * 64 - n, bool)]), bitorder="little").view("<u8").astype(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))[:-1]]).astype(np.int32)
            self.levels.append((bit, packed, counts, int(n - ones.sum())))
            last = np.concatenate([last[~ones], last[ones]])
        self.zero = self._down(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, packed, counts, zeros in self.levels:
            block = at >> 6
            ones = counts[block] + np.bitwise_count(packed[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the strings with ``symbol`` put in front."""
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        shift = self.below[symbol] - self.zero[symbol]
        return both[: len(low)] + shift, both[len(low) :] + shift


def repeated_windows(segments: list[np.ndarray], weights: np.ndarray, window: int) -> list[list[tuple[int, int]]]:
    """Spans under windows that start at two places of the segments at least; a segment of weight 2 counts twice."""
    sizes = np.array([len(s) for s in segments])
    words = np.concatenate(segments)
    number = np.unique(words, return_inverse=True)[1].astype(np.int64) + 1
    first = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(len(words) + len(segments), np.int64)
    text[np.arange(len(words)) + np.repeat(np.arange(len(segments)), sizes)] = number
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    index = FMIndex(text, int(sizes.max()))
    weight = np.concatenate([[0], np.cumsum(weights[owner[index.order]])])
    spans: list[list[tuple[int, int]]] = [[] for _ in segments]
    # Matches [at, end) of segment `who`, all in positions of `text`.
    who = np.flatnonzero(sizes >= window)
    end = first[who] + sizes[who]
    at, low, high = end.copy(), np.zeros(len(who), np.int64), np.full(len(who), len(text))
    while len(who):
        left = at > first[who]
        symbol = text[np.where(left, at - 1, at)]
        new_low, new_high = index.extend(np.where(left, symbol, 0), low, high)
        longer = left & (weight[new_high] - weight[new_low] > 1)
        at = np.where(longer, at - 1, at)
        low, high = np.where(longer, new_low, low), np.where(longer, new_high, high)
        stop = np.flatnonzero(~longer)
        if len(stop):
            size = end[stop] - at[stop]
            enough = size >= window
            for i in stop[enough].tolist():
                spans[who[i]].append((int(at[i] - first[who[i]]), int(end[i] - first[who[i]])))
            # [at - 1, end) has one place: windows that hold it are decided. The next end is the last one of
            # a window that starts before `at` (after a report), or one word earlier.
            end[stop] = np.where(enough, at[stop] + window - 1, end[stop] - 1)
            over = (at[stop] <= first[who[stop]]) & enough | (end[stop] - first[who[stop]] < window)
            at[stop], low[stop], high[stop] = end[stop], 0, len(text)
            if over.any():
                going = np.ones(len(who), bool)
                going[stop[over]] = False
                who, end, at, low, high = who[going], end[going], at[going], low[going], high[going]
    return spans


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row: the words, joined by single spaces, without those
    covered by a window of ``window`` words whose sequence also starts anywhere else.

    Null and empty texts and texts of white space have no words; repeated rows are each other's repeats;
    texts shorter than a window stay whole; extra columns are not read. Words are compared by 64-bit hashes.
    """
    rows = id_and_text(docs, id_col, text_col)
    spans = routing.repeated(rows, window, routing.Words, repeated_windows, chunk=400_000)

    def work(text: bytes, cut: list[tuple[int, int]]) -> tuple:
        words = text.split()
        edges = [0, *(x for s in cut for x in s), len(words)]
        kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
        return len(words), len(words) - len(kept), b" ".join(kept)

    return routing.apply_spans(rows, spans, work, "n_words bigint, n_removed bigint, kept binary")
