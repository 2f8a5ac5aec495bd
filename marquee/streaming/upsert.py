"""Streaming forms of the scheduled loads: land, deduplicate, upsert, count.

Each micro-batch writes only its own newest row per key, under its batch id. The current
state is the newest row per key over all batches, so a batch costs its own size and not
the table's; a batch that is retried replaces exactly what it wrote before.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import latest_per_key

RUN, BATCH = "run", "batch_id"


def landed(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """New files of a landing folder as a stream; the checkpoint remembers which were read."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _new_run() -> int:
    """Later starts have larger numbers."""
    return time.time_ns()


def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Zone-less times cannot carry a watermark; they are read as session-zone times."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def append_bronze(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Poll, land, append: processes what has arrived and stops."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", table)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert(stream: DataFrame, table: str, checkpoint: str, keys: list[str], ts: str, ties: list | None = None) -> StreamingQuery:
    """Keeps ``table`` as a log of per-batch newest rows; see ``current_state``.

    Each start writes to a run of its own, so a new checkpoint, whose batches count from 0
    again, never replaces what an earlier one has written.
    """
    run = _new_run()

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, keys, ts, ties)
        newest.write.mode("overwrite").parquet(f"{table}/{RUN}={run}/{BATCH}={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def current_state(spark: SparkSession, table: str, keys: list[str], ts: str, guard_late: bool = True, ties: list | None = None) -> DataFrame:
    """Newest row per key over all batches. With ``guard_late`` the newest by ``ts`` wins,
    so a late re-delivery of an old row changes nothing; without it the last batch wins."""
    log = spark.read.parquet(table)
    by_batch = [F.col(RUN).desc(), F.col(BATCH).desc()]
    if guard_late:
        return latest_per_key(log, keys, ts, [*by_batch, *(ties or [])]).drop(RUN, BATCH)
    return latest_per_key(log, keys, RUN, [by_batch[1], F.col(ts).desc(), *(ties or [])]).drop(RUN, BATCH)


def compact(spark: SparkSession, table: str, into: str, keys: list[str], ts: str, ties: list | None = None) -> None:
    """Writes the current state as the first batch of a new log, to start over from."""
    current_state(spark, table, keys, ts, ties=ties).write.mode("overwrite").parquet(f"{into}/{RUN}=-1/{BATCH}=-1")


def drop_repeats(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Rediscovered keys within the delay are dropped; state is bounded by the watermark."""
    return event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def counts_per_window(stream: DataFrame, ts: str, window: str, delay: str) -> DataFrame:
    """Rows per load window; windows older than the watermark are final and leave the state."""
    timed = event_time(stream, ts).withWatermark(ts, delay)
    return timed.groupBy(F.window(ts, window)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("load_ts"), "n")


def update_counts(counts: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Writes the windows each batch changed to the same kind of log as ``upsert``."""
    run = _new_run()

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/{RUN}={run}/{BATCH}={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
