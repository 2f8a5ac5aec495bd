"""Nearest neighbours by inner product as a block matrix join.

Vectors are packed into blocks: int8 codes with one scale per vector, the norms of the coded vector and of what
the code leaves out, and the vectors themselves. Each pair of a query block and a candidate block is one tile.
The product of the codes gives every inner product up to a known error,

    |q.x - q'.x'|  <=  |q'| |x - x'| + |q - q'| |x'| + |q - q'| |x - x'|,

so only candidates whose upper bound reaches the k-th largest lower bound of the ids of their tile can be among
the k nearest; an id that stands in several rows has the largest of their bounds. They are recomputed in double precision, and the k best of each tile are merged by one heap per query.
The result is exact.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import per_batch

QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192
_BLOCK = "dim int, n int, ids binary, vectors binary, codes binary, scales binary, norms binary, rests binary"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part: an id, no null or non-finite component, not zero."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.filter(F.col(id_col).isNotNull() & v.isNotNull()).filter(fine).select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))


def _packed(ids: np.ndarray, vectors: np.ndarray) -> list:
    scales = np.abs(vectors).max(1) / 127
    codes = np.rint(vectors / scales[:, None]).astype(np.int8)
    coded = codes * scales[:, None]
    norms, rests = np.sqrt((coded**2).sum(1)), np.sqrt(((vectors - coded) ** 2).sum(1))
    return [vectors.shape[1], len(ids), *(x.tobytes() for x in (ids, vectors, codes, scales, norms, rests))]


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """One row per block of at most ``size`` vectors of one dimension; every partition packs its own rows."""

    def pack(batches):
        held: dict[int, list] = {}
        for batch in batches:
            ids, values = batch.column("vec_id").to_numpy(), batch.column("embedding")
            flat, lengths = values.flatten().to_numpy(zero_copy_only=False), np.asarray(values.value_lengths())
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            for dim in np.unique(lengths):
                mine = np.flatnonzero(lengths == dim)
                rows = held.setdefault(int(dim), [])
                rows.append((ids[mine], flat[starts[mine][:, None] + np.arange(dim)]))
                while sum(len(r[0]) for r in rows) >= size:
                    a, v = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
                    yield _rows([_packed(a[:size], v[:size])])
                    rows[:] = [(a[size:], v[size:])]
        for rows in held.values():
            if rows and sum(len(r[0]) for r in rows):
                yield _rows([_packed(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]))])

    def _rows(made: list[list]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=[c.split()[0] for c in _BLOCK.split(", ")])

    return vectors.mapInArrow(pack, _BLOCK)


class _Block:
    def __init__(self, row: dict, side: str):
        part = lambda name, kind: np.frombuffer(row[side + name], kind)
        dim = row["dim"]
        self.ids, self.vectors = part("ids", np.int64), part("vectors", np.float64).reshape(-1, dim)
        # Sums of products of int8 are exact in float32 up to 1,040 dimensions.
        self.codes = part("codes", np.int8).reshape(-1, dim).astype(np.float32 if dim <= 1040 else np.float64)
        self.scales, self.norms, self.rests = (part(n, np.float64) for n in ("scales", "norms", "rests"))


def _tile(q: _Block, c: _Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of the tile for each query: query ids, candidate ids, inner products."""
    out = []
    by_id = np.argsort(c.ids, kind="stable")
    firsts = np.flatnonzero(np.concatenate([[True], np.diff(c.ids[by_id]) != 0]))
    repeated = len(firsts) < len(c.ids)
    for start in range(0, len(q.ids), 256):
        s = slice(start, start + 256)
        near = (q.codes[s] @ c.codes.T).astype(np.float64)
        near *= q.scales[s, None] * c.scales
        slack = q.norms[s, None] * c.rests + q.rests[s, None] * (c.norms + c.rests)
        slack += 1e-12 * (q.norms[s, None] * c.norms + 1e-300)
        own = q.ids[s, None] == c.ids
        low = np.where(own, -np.inf, near - slack)
        if repeated:
            low = np.maximum.reduceat(low[:, by_id], firsts, axis=1)
        m = low.shape[1]
        floor = np.partition(low, m - k, axis=1)[:, m - k] if m > k else np.full(len(low), -np.inf)
        rows, cols = np.nonzero((near + slack >= floor[:, None]) & ~own)
        left, right = q.vectors[s].T, c.vectors.T
        score = np.zeros(len(rows))
        for d in range(len(left)):  # in the order of the components, as a plain sum
            score += left[d][rows] * right[d][cols]
        ids = c.ids[cols]
        if repeated:  # each id counts once, with its best score
            order = np.lexsort((-score, ids, rows))
            rows, ids, score = rows[order], ids[order], score[order]
            keep = np.ones(len(rows), bool)
            keep[1:] = (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1])
            rows, ids, score = rows[keep], ids[keep], score[keep]
        order = np.lexsort((ids, -score, rows))
        rows, ids, score = rows[order], ids[order], score[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1]) if len(rows) else np.zeros(0, int)
        rank = np.arange(len(rows)) - np.repeat(first, np.diff(np.concatenate([first, [len(rows)]])))
        keep = rank < k
        out.append((q.ids[s][rows[keep]], ids[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the largest inner product with each query row, its
    own id left out, ties to the smaller id. ``is_query`` is a condition on ``vec_id``.

    Null ids and vectors, zero vectors and vectors with null or non-finite components take no part; vectors
    are compared with those of the same dimension; rows repeated under one id count once (if their vectors
    differ, the best score counts, and each query id gets one list); an empty table gives an empty result.
    """
    rows = usable(vectors, id_col, vector_col)
    asked = rows.filter(is_query)
    parts = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    candidates = cut_lineage(blocks(rows, CANDIDATE_BLOCK))
    queries = blocks(asked.repartition(parts), QUERY_BLOCK)
    columns = max(1, candidates.count())
    # Written above, so the numbers of blocks stay as they are.
    candidates = candidates.withColumn("tile", F.pmod(F.xxhash64("ids"), F.lit(columns)))
    queries = queries.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(columns - 1).cast("long"))))
    named = lambda df, side: df.select("dim", "tile", *(F.col(c).alias(side + c) for c in df.columns if c not in ("dim", "tile")))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | pa.Table | None:
        found = [_tile(_Block(r, "q_"), _Block(r, "c_"), k) for r in batch.to_pylist()]
        merged = [np.concatenate(x) for x in zip(*found)]
        return pa.Table.from_arrays([pa.array(x) for x in merged], names=["query_id", "vec_id", "score"])

    tiles = per_batch(named(queries, "q_").join(named(candidates, "c_"), ["dim", "tile"]), work, "query_id bigint, vec_id bigint, score double")

    def merge(batches):
        current, heap, held = None, [], {}

        def ready():
            best = sorted(heap, reverse=True)
            return [(current, i + 1, -item[1], item[0]) for i, item in enumerate(best)]

        out = []
        for batch in batches:
            for query, vec, score in zip(*(batch.column(c).to_pylist() for c in ("query_id", "vec_id", "score"))):
                if query != current:
                    if current is not None:
                        out += ready()
                    current, heap, held = query, [], {}
                item = (score, -vec)
                if vec in held:
                    if held[vec] >= score:
                        continue
                    heap.remove((held[vec], -vec))
                    heapq.heapify(heap)
                    del held[vec]
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    held.pop(-heapq.heapreplace(heap, item)[1])
                else:
                    continue
                held[vec] = score
            if len(out) > 4096:
                yield _result(out)
                out = []
        if current is not None:
            out += ready()
        if out:
            yield _result(out)

    def _result(out):
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["query_id", "rank", "vec_id", "score"])

    return tiles.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(merge, "query_id bigint, rank int, vec_id bigint, score double")
