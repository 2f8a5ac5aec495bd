"""Streaming loads over the events table, compared with their batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import upsert as U
from .quality_queries import micros
from .registry import Tables, query


def _landing(t: Tables) -> tuple[str, str]:
    """The events as landed files in arrival order, and a folder for the rest."""
    base = scratch_path(t.spark, "stream")
    t.events.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(f"{base}/in")
    return f"{base}/in", base


@query("""SELECT user_id, event_id, epoch_us(ts) AS ts_us, event_type FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def stream_upsert(t: Tables):
    source, base = _landing(t)
    stream = U.landed(t.spark, source, t.events.schema, files_per_batch=2)
    U.upsert(stream, f"{base}/log", f"{base}/ck", ["user_id"], "ts", [F.col("event_id")]).awaitTermination()
    state = U.current_state(t.spark, f"{base}/log", ["user_id"], "ts", ties=[F.col("event_id")])
    return state.select("user_id", "event_id", micros("ts").alias("ts_us"), "event_type")


@query("""SELECT user_id, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def stream_late_guard(t: Tables):
    """Older snapshots of every user delivered again, last, must not win."""
    source, base = _landing(t)
    log, check = f"{base}/log", f"{base}/ck"
    stream = U.landed(t.spark, source, t.events.schema)
    U.upsert(stream, log, check, ["user_id"], "ts", [F.col("event_id")]).awaitTermination()
    oldest = t.events.groupBy("user_id").agg(F.min("ts").alias("ts"))
    t.events.join(oldest, ["user_id", "ts"], "left_semi").write.mode("append").parquet(source)
    stream = U.landed(t.spark, source, t.events.schema)
    U.upsert(stream, log, check, ["user_id"], "ts", [F.col("event_id")]).awaitTermination()
    compacted = f"{base}/compacted"
    U.compact(t.spark, log, compacted, ["user_id"], "ts", [F.col("event_id")])
    return U.current_state(t.spark, compacted, ["user_id"], "ts").select("user_id", "event_id")


@query("SELECT event_id, user_id FROM events")
def stream_bronze_append(t: Tables):
    """Files that arrive after the first run are picked up by the next one, each once."""
    source, base = _landing(t)
    for _ in range(2):
        stream = U.landed(t.spark, source, t.events.schema, files_per_batch=1)
        U.append_bronze(stream, f"{base}/bronze", f"{base}/ck").awaitTermination()
    return t.spark.read.parquet(f"{base}/bronze").select("event_id", "user_id")


@query("SELECT event_id, user_id FROM events")
def stream_dedup(t: Tables):
    """Every event delivered twice leaves once."""
    source, base = _landing(t)
    t.events.write.mode("append").parquet(source)
    stream = U.drop_repeats(U.landed(t.spark, source, t.events.schema), ["event_id"], "ts", "60 days")
    U.append_bronze(stream, f"{base}/once", f"{base}/ck").awaitTermination()
    return t.spark.read.parquet(f"{base}/once").select("event_id", "user_id")


@query("SELECT epoch_us(date_trunc('day', ts)) AS run_us, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(t: Tables):
    """Each batch updates the windows it touches; the last update of a window stands."""
    source, base = _landing(t)
    counts = U.counts_per_window(U.landed(t.spark, source, t.events.schema, files_per_batch=1), "ts", "1 day", "40 days")
    U.update_counts(counts, f"{base}/daily", f"{base}/ck").awaitTermination()
    return U.current_state(t.spark, f"{base}/daily", ["load_ts"], "n", guard_late=False).select(micros("load_ts").alias("run_us"), "n")
