"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of ``least`` words share a seed. For such pairs the longest
common run of words not yet tiled is found by Karp-Rabin hashing (a search over its length), marked as a tile in
both, and so on until no run of ``least`` words is left. The share of the item's words under tiles is its
coverage; order doesn't matter, so reordered passages count like verbatim ones.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import dealt_by_size, id_and_text, per_batch, texts_of

WORD = re.compile(r"\w+")
#: Words of benchmark text that one broadcast may hold; a larger benchmark is taken in parts.
MAX_WORDS = 1_000_000
_B, _M = 1_000_003, (1 << 61) - 1


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _windows(run: list[int], size: int):
    """(hash, start) of each window of a run of word numbers, rolled along."""
    top, h = pow(_B, size - 1, _M), 0
    for i, x in enumerate(run):
        if i >= size:
            h = (h - run[i - size] * top) % _M
        h = (h * _B + x) % _M
        if i + 1 >= size:
            yield h, i + 1 - size


def _common(a: list[tuple[int, list[int]]], b: list[tuple[int, list[int]]], size: int) -> tuple[int, int] | None:
    """Starts of the first common window of ``size`` words in the unmarked runs of two sequences."""
    found: dict[int, list[tuple[int, int, list[int]]]] = defaultdict(list)
    for offset, run in a:
        for h, i in _windows(run, size):
            found[h].append((offset + i, i, run))
    for offset, run in b:
        for h, j in _windows(run, size):
            for start, i, other in found.get(h, ()):
                if other[i : i + size] == run[j : j + size]:
                    return start, offset + j
    return None


def _without(runs: list[tuple[int, list[int]]], start: int, size: int, least: int) -> list[tuple[int, list[int]]]:
    out = []
    for offset, run in runs:
        if offset <= start < offset + len(run):
            out += [(offset, run[: start - offset]), (start + size, run[start - offset + size :])]
        else:
            out.append((offset, run))
    return [(o, r) for o, r in out if len(r) >= least]


def tiles(item: list[int], runs: list[tuple[int, list[int]]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in the item, start in the document, words), longest first. ``runs`` are pieces of
    the document with their offsets."""
    left, right = [(0, item)], [(o, r) for o, r in runs if len(r) >= least]
    out, longest = [], len(item)
    while left and right:
        low, high, best = least, min(longest, max(len(r) for _, r in left), max(len(r) for _, r in right)), None
        while low <= high:  # a common run of n words holds one of n - 1
            size = (low + high + 1) // 2
            at = _common(left, right, size)
            if at:
                best, low = (*at, size), size + 1
            else:
                high = size - 1
        if best is None:
            break
        out.append(best)
        longest = best[2]
        left, right = _without(left, best[0], best[2], least), _without(right, best[1], best[2], least)
    return out


class Seeds:
    """A part of the benchmark: its words as numbers and, by length, the hashes of its seeds."""

    def __init__(self, items: list[tuple[int, str]], least: int):
        self.least, self.number = least, {}
        self.items = [(i, [self.number.setdefault(w, len(self.number) + 1) for w in words_of(t)]) for i, t in items]
        self.items = [(i, w) for i, w in self.items if w]
        where: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, (_, w) in enumerate(self.items):
            size = min(least, len(w))
            hashes = self.hashes(np.array(w, np.int64), size)
            for at, h in enumerate(hashes.tolist()):
                where.setdefault(size, {}).setdefault(h, []).append((k, at))
        self.where = where
        self.sorted = {size: np.array(sorted(found), np.uint64) for size, found in where.items()}

    @staticmethod
    def hashes(ids: np.ndarray, size: int) -> np.ndarray:
        h = np.zeros(max(0, len(ids) - size + 1), np.uint64)
        for i in range(size):
            h = (h ^ ids[i : len(ids) - size + 1 + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h

    def matches(self, texts: list[str], coverage: float) -> list[list[tuple[int, int, int, list]]]:
        """For each text (item id, words tiled, words of the item, tiles) of the items it covers enough."""
        get = self.number.get
        words = [[get(w, 0) for w in WORD.findall(t.lower())] for t in texts]
        ends = np.cumsum([len(w) for w in words])
        flat = np.fromiter((x for w in words for x in w), np.int64, count=int(ends[-1]) if len(ends) else 0)
        found: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))  # text, item, starts in the text
        cover: dict[tuple[int, int], set[int]] = defaultdict(set)
        for size, hashes in self.sorted.items():
            # Windows with a word the benchmark lacks can't match.
            lacks = np.concatenate([[0], np.cumsum(flat == 0)])
            starts = np.flatnonzero(lacks[size:] == lacks[: len(lacks) - size]) if len(flat) >= size else np.zeros(0, int)
            if not len(starts):
                continue
            text = np.searchsorted(ends, starts, side="right")
            whole = starts + size <= ends[text]
            starts, text = starts[whole], text[whole]
            h = np.zeros(len(starts), np.uint64)
            for i in range(size):
                h = (h ^ flat[starts + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[at] == h
            for s, t, x in zip(starts[hit].tolist(), text[hit].tolist(), h[hit].tolist()):
                first = int(ends[t]) - len(words[t])
                for k, where in self.where[size][x]:
                    found[t][k].add(s - first)
                    cover[t, k].update(range(where, where + size))
        out = []
        for t in range(len(texts)):
            mine = []
            for k in sorted(found.get(t, ())):
                item, ids = self.items[k]
                if len(cover[t, k]) < coverage * len(ids):  # tiles lie within shared seeds
                    continue
                least = min(self.least, len(ids))
                tiled = tiles(ids, _runs(words[t], sorted(found[t][k]), least), least)
                n = sum(x[2] for x in tiled)
                if n >= coverage * len(ids):
                    mine.append((item, n, len(ids), tiled))
            out.append(mine)
        return out


def _runs(words: list[int], starts: list[int], size: int) -> list[tuple[int, list[int]]]:
    """The pieces of a document that its seeds cover."""
    out: list[list[int]] = []
    for s in starts:
        if out and s <= out[-1][1]:
            out[-1][1] = s + size
        else:
            out.append([s, s + size])
    return [(a, words[a:b]) for a, b in out]


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = 5, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: str | None = None) -> DataFrame:
    """``doc_id, item_id, n_tiled, n_words, coverage, tiles`` for every document and item of which at least
    ``coverage`` of the words lie under tiles of ``least`` words or more. With ``keep`` instead all columns of
    the documents and a boolean column of that name, true where there is no such item.

    Words are runs of letters, digits and underscores, in lower case. An item with fewer than ``least`` words
    has one seed, the whole of it; items and documents without words match nothing. Null texts have no words;
    rows of either side with null ids count like others, repeated rows repeat. The benchmark is sent to all
    tasks in parts of ``MAX_WORDS`` words and one item at most, so its size decides only the number of passes.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text")).filter("text is not null").distinct()
    items, parts = dealt_by_size(items, lambda texts: [len(words_of(t)) for t in texts], MAX_WORDS)
    out = docs if keep else None
    for part in range(max(1, parts)):
        rows = sorted(((r["item"], r["text"]) for r in items.filter(F.col("part") == part).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        sent = spark.sparkContext.broadcast(Seeds(rows, least))
        if keep:
            out = _flagged(out, sent, coverage, text_col, keep, fresh=part == 0)
        else:
            found = _listed(id_and_text(docs, id_col, text_col), sent, coverage)
            out = found if out is None else out.unionByName(found)
    return out


def _listed(docs: DataFrame, sent, coverage: float) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.Table | None:
        ids = batch.column("doc_id").to_pylist()
        rows = [(i, item, n, size, n / size, [{"item_start": a, "doc_start": b, "words": c} for a, b, c in t]) for i, found in zip(ids, sent.value.matches(texts_of(batch), coverage)) for item, n, size, t in found]
        if not rows:
            return None
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.struct([(c, pa.int32()) for c in ("item_start", "doc_start", "words")]))]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "item_id", "n_tiled", "n_words", "coverage", "tiles"])

    return per_batch(docs.withColumn("doc_id", F.col("doc_id").cast("long")), work, "doc_id bigint, item_id bigint, n_tiled int, n_words int, coverage double, tiles array<struct<item_start:int,doc_start:int,words:int>>")


def _flagged(docs: DataFrame, sent, coverage: float, text_col: str, keep: str, fresh: bool) -> DataFrame:
    if fresh and keep in docs.columns:
        raise ValueError(f"column {keep} is taken")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        clean = np.array([not found for found in sent.value.matches(texts_of(batch, text_col), coverage)])
        if not fresh:
            clean &= np.array(batch.column(keep).to_pylist(), bool)
        names = [n for n in batch.schema.names if n != keep]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(clean)], names=[*names, keep])

    schema = T.StructType([*docs.schema.fields, *([T.StructField(keep, T.BooleanType())] if fresh else [])])
    return per_batch(docs, work, schema)
