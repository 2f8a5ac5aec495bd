"""Ranked search of documents for the words of given items: term-at-a-time for short lists, then
document-at-a-time over long ones.

Documents are read once into blocks: for each term some item asks for, the documents of the block that hold it and how
often. Blocks are stored; a task searches its blocks one after the other for all items and keeps each item's best.

In a block, an item's short lists are summed into accumulators, term by term. The accumulators, in the order of
documents and bounded by their largest sum, then count as one more list beside the long ones. All lists are passed
document by document, in steps of many: as long as the bounds of some lists add up to less than the k-th best
score so far, a document in none of the other lists can't enter, so these lists are only looked up for documents
that the others name, from the highest bound on, and documents that can't enter any more are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import terms
from .common import dealt_by_size
from .routing import span_hashes

#: Distinct terms of the items searched for in one pass over the documents, and one item more at most: bounds the broadcast.
MAX_TERMS = 1_000_000
#: Postings and documents of a block, from which on it is complete.
POSTINGS, DOCUMENTS = 1 << 21, 1 << 16
#: Short lists of an item hold at most this share of the block's documents together.
SHORT = 0.125
#: Documents of the first step; each further one takes four times as many.
STEP = 1024
_BLOCK = "ids array<bigint>, lengths binary, terms binary, starts binary, places binary, times binary"


def hashes_of(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and 64-bit hash of each term, long texts in several parts."""
    for numbers, parts, _ in terms.pieces(texts):
        data, part, starts, ends = terms.spans(parts)
        yield np.array(numbers)[part], span_hashes(data, starts, ends) if len(data) else np.zeros(0, np.uint64)


def terms_of_items(texts: list[bytes | None]) -> list[np.ndarray]:
    """The distinct terms of each text."""
    found: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)] for _ in texts]
    for doc, h in hashes_of(texts):
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for i, part in zip(doc[np.concatenate([[0], cuts])].tolist() if len(doc) else [], np.split(h, cuts)):
            found[i].append(np.unique(part))
    return [np.unique(np.concatenate(x)) for x in found]


def index(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Blocks of ``docs (doc_id, text)``: documents with their numbers of terms, and for each of the ``wanted`` terms
    (sorted hashes) found in them the documents and how often they hold it."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def block() -> pa.RecordBatch:
            term, place, times = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((place, term))
            term, place, times = term[order], place[order], times[order]
            starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
            parts = [np.concatenate(lengths), term[starts].astype(np.uint32), starts.astype(np.uint32), place.astype(np.uint32), times.astype(np.uint32)]
            row = [pa.array([ids], pa.list_(pa.int64())), *(pa.array([p.tobytes()], pa.binary()) for p in parts)]
            return pa.RecordBatch.from_arrays(row, names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            n = batch.num_rows
            length = np.zeros(n, np.int64)
            keys, counts = [], []
            for doc, h in hashes_of(batch.column("text").to_pylist()):
                length += np.bincount(doc, minlength=n)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[at] == h
                key, times = np.unique(doc[hit] * len(known) + at[hit], return_counts=True)
                keys.append(key)
                counts.append(times)
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            times = np.bincount(at, np.concatenate(counts), minlength=len(key)).astype(np.int64)
            found.append((key % len(known), key // len(known) + len(ids), times))
            ids += batch.column("doc_id").to_pylist()
            lengths.append(length)
            size += len(key)
            if size >= POSTINGS or len(ids) >= DOCUMENTS:
                yield block()
                ids, lengths, found, size = [], [], [], 0
        if ids:
            yield block()

    return docs.mapInArrow(work, _BLOCK)


class _Block:
    """A block with the share of the score that doesn't depend on the item, of each posting and at most of each list."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        part = lambda name, kind=np.uint32: np.frombuffer(row[name], kind)
        self.ids = row["ids"]
        lengths = part("lengths", np.int64)
        if 90 * int(lengths.max(initial=0)) * n_docs < 1 << 63:
            norm = 10 + (90 * lengths * n_docs) // max(1, n_terms)
        else:  # beyond 64 bits
            norm = np.array([10 + 90 * n * n_docs // n_terms for n in lengths.tolist()], np.int64)
        self.terms, self.places = part("terms"), part("places").astype(np.int64)
        times = part("times").astype(np.int64)
        self.bases = (1_000_000_000 * times) // (1000 * times + 8 * norm[self.places]) if len(times) else times
        self.starts = np.append(part("starts"), len(self.places)).astype(np.int64)
        self.bounds = np.maximum.reduceat(self.bases, self.starts[:-1]) if len(self.terms) else self.bases

    def lists(self, wanted: np.ndarray, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int, int]]:
        """Documents, shares, weight and bound of the list of each wanted term in the block, shortest first."""
        at = np.searchsorted(self.terms, wanted)
        out = []
        for i, term, w in zip(at.tolist(), wanted.tolist(), weights.tolist()):
            if w and i < len(self.terms) and self.terms[i] == term:
                s = slice(self.starts[i], self.starts[i + 1])
                out.append((self.places[s], self.bases[s], w, w * int(self.bounds[i])))
        return sorted(out, key=lambda x: len(x[0]))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Documents of all parts in order and the sums of their scores."""
    docs, scores = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(docs, kind="stable")
    docs, scores = docs[order], scores[order]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[first], np.add.reduceat(scores, first)


class Best:
    """The k best documents so far: highest score, then least id, null ids last."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], 1

    def add(self, ids: list[int | None], scores: list[int]) -> None:
        both = sorted([*self.rows, *((-s, i is None, 0 if i is None else i) for s, i in zip(scores, ids))])
        self.rows = both[: self.k]
        if len(self.rows) == self.k:
            self.floor = max(1, -self.rows[-1][0])


def look_up(block: _Block, wanted: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Adds the block's documents for one item to its best."""
    lists = block.lists(wanted, weights)
    if not lists or sum(x[3] for x in lists) < best.floor:
        return
    room, short = SHORT * len(block.ids), 0
    while short < len(lists) and len(lists[short][0]) <= room:
        room -= len(lists[short][0])
        short += 1
    long = [(docs, bases, w, bound) for docs, bases, w, bound in lists[short:]]
    if short:  # term by term into accumulators, from here on one list among the others
        docs, scores = _summed([(docs, bases * w) for docs, bases, w, _ in lists[:short]])
        long.append((docs, scores, 1, int(scores.max())))
    long.sort(key=lambda x: x[3])
    below = np.cumsum([x[3] for x in long]).tolist()
    at, step, end = 0, STEP, len(block.ids)
    while at < end:
        stop = min(end, at + step)
        # Documents that are only in the first lists can't reach the floor.
        optional = sum(b < best.floor for b in below)
        if optional == len(long):
            return
        parts = []
        for docs, bases, w, _ in long[optional:]:
            a, b = np.searchsorted(docs, (at, stop)).tolist()
            if a < b:
                parts.append((docs[a:b], bases[a:b] * w))
        if parts:
            docs, scores = _summed(parts) if len(parts) > 1 else parts[0]
            for nth in range(optional - 1, -1, -1):
                able = scores + below[nth] >= best.floor
                docs, scores = docs[able], scores[able]
                if not len(docs):
                    break
                other, bases, w, _ = long[nth]
                place = np.minimum(np.searchsorted(other, docs), len(other) - 1)
                scores = scores + np.where(other[place] == docs, bases[place] * w, 0)
            able = np.flatnonzero(scores >= best.floor)
            if len(able):
                if len(able) > best.k:  # all those that reach the k-th of this step, ties included
                    low = np.partition(scores[able], len(able) - best.k)[len(able) - best.k]
                    able = able[scores[able] >= low]
                best.add([block.ids[i] for i in docs[able].tolist()], scores[able].tolist())
        at, step = stop, step * 4


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 for each row of ``items``.

    Terms are told apart by 64-bit hashes: among a billion different words, one of the terms of a pass is mistaken
    for another word with a probability of about one in 20,000. Null and empty texts have no terms; items without
    terms or matches give no rows. Texts of any length are read whole, in pieces. Every row is a document or an item of its own, also
    of repeated ids and texts; equal scores are ordered by id, null ids last. Other columns aren't read, whatever
    their names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked, parts = dealt_by_size(asked, lambda texts: [len(x) for x in terms_of_items([t.encode() for t in texts])], MAX_TERMS)
    result = None
    for part in range(parts):
        mine = [(r["item_id"], r["text"].encode()) for r in asked.filter((F.col("part") == part) & F.col("text").isNotNull()).collect()]
        terms_of = terms_of_items([text for _, text in mine])
        mine = [(item, wanted) for (item, _), wanted in zip(mine, terms_of) if len(wanted)]
        if not mine:
            continue
        found = _pass(rows, [item for item, _ in mine], [wanted for _, wanted in mine], part, k)
        result = found if result is None else result.unionByName(cut_lineage(found))
    if result is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _pass(rows: DataFrame, ids: list[int | None], asked: list[np.ndarray], nth: int, k: int) -> DataFrame:
    """Each task's best documents for some items and their terms; ``slot`` numbers the items."""
    wanted = np.unique(np.concatenate(asked))
    numbers = [np.searchsorted(wanted, one) for one in asked]
    blocks = cut_lineage(index(rows, wanted))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(wanted), np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for row in batch.to_pylist():
                starts = np.append(np.frombuffer(row["starts"], np.uint32), len(row["places"]) // 4).astype(np.int64)
                df[np.frombuffer(row["terms"], np.uint32)] += np.diff(starts)
                lengths = np.frombuffer(row["lengths"], np.int64)
                n_docs, n_terms = n_docs + int((lengths > 0).sum()), n_terms + int(lengths.sum())
        used = np.flatnonzero(df)
        columns = np.concatenate([[-2, -1], used]), np.concatenate([[n_docs, n_terms], df[used]])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["term", "n"])

    summed = blocks.select("lengths", "terms", "starts", "places").mapInArrow(totals, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    count = dict(zip(summed.column("term").to_pylist(), summed.column("n").to_pylist()))
    n_docs, n_terms = count.pop(-2, 0), count.pop(-1, 0)
    weights = np.zeros(len(wanted), np.int64)
    for term, df in count.items():
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    shared = rows.sparkSession.sparkContext.broadcast((ids, numbers, [weights[one] for one in numbers]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists, scales = shared.value
        best = [Best(k) for _ in ids]
        for batch in batches:
            for at in range(batch.num_rows):
                block = _Block(batch.slice(at, 1).to_pylist()[0], n_docs, n_terms)
                for one, numbers, scale in zip(best, lists, scales):
                    look_up(block, numbers, scale, one)
        made = [((nth << 40) + slot, ids[slot], None if none else i, -s) for slot, one in enumerate(best) for s, none, i in one.rows]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], names=["slot", "item_id", "doc_id", "score"])

    return blocks.mapInArrow(work, "slot bigint, item_id bigint, doc_id bigint, score bigint")
