"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


#: What this worker holds from one task to the next, by its key.
_KEPT: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """``make()``, held for the next tasks of this worker; one thing at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go(key: tuple | None = None) -> None:
    """Drops what the worker holds under other keys, and gives memory that Arrow has no use for back to the machine:
    workers outlive their stage, and what they don't give back is lacking in the next one."""
    for other in [k for k in _KEPT if k != key]:
        del _KEPT[other]
    pa.default_memory_pool().release_unused()


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str, key: tuple | None = None) -> DataFrame:
    """``work`` on each Arrow batch; partitions stay as they are and nothing is shuffled. ``key``: of what it has ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(key)
        for batch in batches:
            made = work(batch) if batch.num_rows else None
            if made is not None and made.num_rows:
                yield from made.to_batches(max_chunksize=2048) if isinstance(made, pa.Table) else [made]
            del batch, made
            let_go(key)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def slices(texts: list[str | None], limit: int = 1 << 20) -> Iterator[slice]:
    """Consecutive parts of a batch with about ``limit`` characters each, which bounds what a worker makes of them at a time."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size > limit:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def text_key(text: Column | str) -> Column:
    """128 bits that stand for a whole text. Rows with the same text share every decision that depends on
    the text alone, whatever their ids, null or repeated."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names, so that columns of the input with other
    names never clash with columns the operators add."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _ranges(kind: str, end: int = 0x180) -> str:
    """Characters below ``end`` of a Unicode category, as the inside of a character class."""
    codes = [c for c in range(end) if unicodedata.category(chr(c))[0] == kind]
    starts = [c for c in codes if c - 1 not in codes]
    ends = [c for c in codes if c + 1 not in codes]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


#: Classes of the Latin blocks, spelled out: ``re`` runs them several times faster than property classes.
LETTER, NUMBER, SPACE = _ranges("L"), _ranges("N"), "\t-\r \x85\xa0"
#: Finds a character outside the blocks for which those classes hold (and where normal forms or case maps
#: would matter); texts without one may take the fast patterns.
NOT_PLAIN = re.compile("[^\t-\r -~\xa0-įı-ſ‐-‧€]").search


def packed(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``key, doc_id, text``) with texts as compressed UTF-8, for a shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        press = zstandard.ZstdCompressor(level=3).compress
        texts = pa.array([press(t.encode()) for t in texts_of(batch)], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), texts], names=["key", "doc_id", "text"])

    return per_batch(rows.select("key", "doc_id", "text"), work, "key binary, doc_id bigint, text binary")


def unpacked(column: pa.Array) -> list[bytes]:
    press = zstandard.ZstdDecompressor().decompress
    return [press(t) for t in column.to_pylist()]


def dealt_by_size(rows: DataFrame, size: Callable[[list[str]], list[int]], limit: int) -> tuple[DataFrame, int]:
    """``rows`` (with ``text``) and the number of the part each belongs to, in ``part``, and the number of parts. The sizes of
    a part's texts come to ``limit`` at most, but for its last text. Rows are numbered by running sums: within each
    partition in its task, and over partitions by one total of each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            before = []
            for n in size(texts_of(batch)):
                before.append(total)
                total += n
            place = [TaskContext.get().partitionId()] * batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int32()), pa.array(before, pa.int64()), pa.array([total] * batch.num_rows, pa.int64())], names=[*batch.schema.names, "_place", "_before", "_total"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    sized = cut_lineage(rows.mapInArrow(work, f"{kinds}, _place int, _before bigint, _total bigint"))
    totals = sorted(map(tuple, sized.groupBy("_place").agg(F.max("_total")).collect()))
    starts, at = [], 0
    for place, total in totals:
        starts.append((place, at))
        at += total
    if not starts:
        return rows.withColumn("part", F.lit(0).cast("long")), 0
    start = rows.sparkSession.createDataFrame(starts, "_place int, _start bigint")
    part = F.floor((F.col("_start") + F.col("_before")) / F.lit(limit)).cast("long")
    dealt = sized.join(F.broadcast(start), "_place").select(*rows.columns, part.alias("part"))
    return dealt, max(1, -(-at // limit))
