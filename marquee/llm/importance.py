"""Resampling of documents towards the distribution of a target set.

Words and runs of words fall into buckets by their CRC-32. What a bucket gains is the logarithm of its share in the
target over its share in the documents; a document weighs the sum of its gains, looked up in one array per batch.
With Gumbel noise from a hash of the id, the documents of the highest scores are a draw without replacement.

The order is made by a distributed LSD radix sort. The key is the score, falling, then the id, rising; only the
bits in which keys differ are sorted, some at a time from the last on. In each pass the rows of a block are counted by digit in
their present order, a row's number among those of its block and digit is its local place, the counts of all blocks
become offsets (all smaller digits, then the same digit in the blocks before), and offset plus local place is the
row's next position. Rows are sent to the block of their position by number. The last positions are the ranks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import terms

BUCKETS = 10_000
#: Bits of a digit, which bound the table of digit totals, and rows of a block at most.
DIGIT, BLOCK = 11, 1 << 20
_SIGN = np.uint64(1 << 63)


def buckets_of(texts: list[bytes | None], longest: int = 1, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Number of the text and bucket of each feature: all runs of 1 to ``longest`` terms."""
    for numbers, parts, seen in terms.pieces(texts, longest - 1):
        data, part, starts, ends = terms.spans(parts)
        first = np.searchsorted(part, np.arange(len(parts)))
        nth = np.arange(len(part)) - first[part] if len(part) else part
        for run in range(1, longest + 1):
            head = np.arange(max(0, len(part) - run + 1))
            tail = head + run - 1
            good = (part[head] == part[tail]) & (nth[tail] >= seen[part[tail]])
            head, tail = head[good], tail[good]
            yield np.array(numbers)[part[head]], terms.crc32_of(data, starts[head], ends[tail]) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows of ``texts (text)`` fall into each bucket. Partitions count by themselves;
    one row per partition and bucket is shuffled, one per bucket comes back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in buckets_of(batch.column("text").to_pylist(), longest, buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    summed = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What each bucket adds to a weight, in thousandths of a natural logarithm, rounded down."""
    n = len(source)
    s_all, t_all = int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, count, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            for nth, (doc, bucket) in enumerate(buckets_of(batch.column("text").to_pylist(), longest, len(shared.value))):
                found = np.bincount(doc, minlength=n)
                count += found
                if nth % longest == 0:  # the runs of one term come first
                    words += found
                weight += np.bincount(doc, shared.value[bucket], minlength=n)
            weight = np.rint(weight).astype(np.int64)
            score = weight + np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (words, count, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.mapInArrow(work, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


class _Key:
    """Digits of the key (score falling, id rising), numbered from the last."""

    def __init__(self, low_score: int, high_score: int, low_id: int, high_id: int):
        self.high = high_score
        self.score_bits = (high_score - low_score).bit_length()
        sign = 1 << 63
        self.id_bits = ((low_id % (1 << 64) ^ sign) ^ (high_id % (1 << 64) ^ sign)).bit_length()
        bits = max(1, self.score_bits + self.id_bits)
        self.passes = -(-bits // DIGIT)
        self.width = -(-bits // self.passes)

    def digit(self, score: np.ndarray, doc_id: np.ndarray, nth: int) -> np.ndarray:
        up = (self.high - score).view(np.uint64)
        down = doc_id.view(np.uint64) ^ _SIGN
        if self.id_bits < 64:
            down = down & np.uint64((1 << self.id_bits) - 1)
        at = nth * self.width
        out = down >> np.uint64(at) if at < 64 else np.zeros_like(down)
        if at >= self.id_bits:
            out = up >> np.uint64(at - self.id_bits)
        elif self.id_bits - at < self.width:
            out = out | (up << np.uint64(self.id_bits - at))
        return (out & np.uint64((1 << self.width) - 1)).astype(np.int64)


def radix_ranked(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``doc_id`` and ``score``, both bigint) and ``rank``, from 1: highest score first, then least
    id, null ids last. Rows with the same score and id have neighbouring ranks. ``rows`` should be stored."""
    spark = rows.sparkSession
    key_id = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    n, *ends = rows.agg(F.count("*"), F.min("score"), F.max("score"), F.min(key_id), F.max(key_id)).first()
    columns = rows.columns
    if not n:
        return rows.withColumn("rank", F.lit(1).cast("long"))
    key = _Key(*ends)
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCK))
    per_block = -(-n // blocks)

    def counting(nth: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            taken = np.zeros(1 << key.width, np.int64)
            block = None
            for batch in batches:
                ids = batch.column("doc_id").fill_null((1 << 63) - 1).to_numpy()
                digit = key.digit(batch.column("score").to_numpy(), ids, nth)
                blocks_of = batch.column("block").to_numpy() if nth else np.full(len(digit), TaskContext.get().partitionId(), np.int64)
                local = np.empty(len(digit), np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(blocks_of)) + 1).tolist(), len(digit)]
                for a, b in zip(cuts, cuts[1:]):
                    if a == b:
                        continue
                    if blocks_of[a] != block:
                        taken[:], block = 0, blocks_of[a]
                    mine = digit[a:b]
                    order = np.argsort(mine, kind="stable")
                    count = np.bincount(mine, minlength=len(taken))
                    first = np.cumsum(count) - count
                    local[a + order] = np.arange(b - a) - first[mine[order]] + taken[mine[order]]
                    taken += count
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *map(pa.array, (blocks_of, digit, local))], names=[*columns, "block", "digit", "local"])

        return work

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    schema = f"{kinds}, block bigint, digit bigint, local bigint"
    state = rows
    for nth in range(key.passes):
        # Stored with their blocks, so that a row's place doesn't depend on how the table is read again.
        state = cut_lineage(state.mapInArrow(counting(nth), schema))
        counts = cut_lineage(state.groupBy("digit", "block").agg(F.count("*").alias("n")))
        digits = sorted(tuple(r) for r in counts.groupBy("digit").agg(F.sum("n")).collect())  # at most 2 ** DIGIT rows
        before = np.cumsum([0, *(m for _, m in digits)])[:-1]
        smaller = spark.createDataFrame([(d, int(b)) for (d, _), b in zip(digits, before)], "digit bigint, smaller bigint")
        same = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("earlier", F.coalesce(F.sum("n").over(same), F.lit(0))).join(F.broadcast(smaller), "digit").select("digit", "block", (F.col("smaller") + F.col("earlier")).alias("offset"))
        placed = state.join(offsets, ["digit", "block"]).select(*columns, (F.col("offset") + F.col("local")).alias("pos"))
        if nth + 1 < key.passes:
            placed = placed.withColumn("block", F.floor(F.col("pos") / F.lit(per_block)).cast("long"))
            state = placed.repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions("block", "pos")
    return placed.select(*columns, (F.col("pos") + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; ``rank`` counts the drawn ones from 1
    and is null for the others. ``percent`` of the documents with ``min_words`` words are drawn, rounded down.

    Null and empty texts have no features and weigh 0; texts of any length are read whole, in pieces. Every row is
    a document, also of repeated ids and texts; a null id is hashed as the empty text and comes last among equal
    scores. Other columns aren't read, whatever their names; an empty table gives an empty result, an empty target
    a target without features.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    gain = gains(bucket_counts(rows, longest, buckets), bucket_counts(target.select(F.col(target_col).alias("text")), longest, buckets))
    scored = cut_lineage(scores(rows, gain, longest, seed))
    able: Column = F.col("n_words") >= min_words
    drawn = percent * scored.filter(able).count() // 100
    ranked = radix_ranked(scored.filter(able)).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long")))
