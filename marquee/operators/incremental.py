"""Loading only what changed and keeping current state and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import first_per_key, latest_per_key
from .skew import skew_join, top_per_group


def watermark(df: DataFrame | None, column: str) -> Column | None:
    """High watermark as a scalar subquery: no row of the table reaches the driver.
    ``None`` when there is no table yet or it was never stamped."""
    if df is None or column not in df.columns:
        return None
    return df.agg(F.max(column)).scalar()


def changed_since(df: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows on or after the watermark's day; everything when there is no watermark."""
    if mark is None:
        return df
    return df.filter(mark.isNull() | (F.col(column).cast("date") >= mark.cast("date")))


def discover(df: DataFrame, date_col: str, start: Column, end: Column, min_votes: int | None = None) -> DataFrame:
    """Keys dated within ``[start, end]``, both days included, with an optional vote floor."""
    found = df.filter(F.col(date_col).cast("date").between(start, end))
    return found if min_votes is None else found.filter(F.col("vote_count") >= min_votes)


def new_keys(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key was never landed."""
    return incoming.join(existing.select(*keys).distinct(), keys, "left_anti")


def refresh_window(df: DataFrame, date_col: str, today: Column, days: int = 540) -> DataFrame:
    """Recently released rows, whose metrics still move."""
    return df.filter(F.col(date_col).cast("date") >= F.date_sub(today.cast("date"), days))


def refresh_keys(df: DataFrame, key: str, year_col: str, this_year: int | Column, fresh: DataFrame, years: int = 2) -> DataFrame:
    """Keys of the last calendar years together with the keys that are new this run."""
    since = (F.lit(this_year) if isinstance(this_year, int) else this_year) - F.lit(years)
    recent = df.filter(F.col(year_col).try_cast("int") >= since).select(key)
    return recent.union(fresh.select(key)).distinct()


def _match_keys(df: DataFrame, keys: list[str], null_safe: list[str], *extra: str) -> tuple[DataFrame, Column]:
    """Keys of ``df`` under other names, and the condition that matches them."""
    other = df.select(*[F.col(c).alias(f"_m_{c}") for c in [*keys, *extra]])
    match = F.lit(True)
    for k in keys:
        theirs = F.col(f"_m_{k}")
        match = match & (F.col(k).eqNullSafe(theirs) if k in null_safe else F.col(k) == theirs)
    return other, match


def merge_scd1(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    null_safe_keys: list[str] = (),
    order_by: str | None = None,
    newer_only: bool = False,
) -> DataFrame:
    """Current state after an upsert: update all columns on match, insert otherwise.

    The source is reduced to one row per key first. ``newer_only`` keeps a target row
    that carries a later ``order_by`` than the delivery.
    """
    fresh = latest_per_key(source, keys, order_by) if order_by else first_per_key(source, keys)
    if newer_only:
        held, match = _match_keys(target, keys, null_safe_keys, order_by)
        fresh = fresh.join(held, match & (F.col(f"_m_{order_by}") > F.col(order_by)), "left_anti")
    replaced, match = _match_keys(fresh, keys, null_safe_keys)
    return target.join(replaced, match, "left_anti").unionByName(fresh, allowMissingColumns=True)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows stay untouched; only unseen keys are added."""
    unseen = new_keys(first_per_key(source, keys), target, keys)
    return target.unionByName(unseen, allowMissingColumns=True)


def scd2_history(snapshots: DataFrame, key: str, ts: str, ties: list | None = None) -> DataFrame:
    """Every snapshot once, with the newest of each key flagged ``is_current``.

    The flag is a join on (key, time) rather than a window over the key, so a key with a
    very long history is spread over tasks like any other. A null key is a key like any
    other; a row without a time is current only where its key has no other row.
    """
    once = first_per_key(snapshots, [key, ts], ties)
    newest = once.groupBy(F.col(key).alias("_key")).agg(F.max(ts).alias("_ts")).withColumn("_newest", F.lit(True))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(ts).eqNullSafe(F.col("_ts"))
    flagged = once.join(newest, same, "left").withColumn("is_current", F.coalesce("_newest", F.lit(False)))
    return flagged.drop("_newest", "_key", "_ts")


def previous_in_time(df: DataFrame, key: str, ts: str, columns: list[str], unit: str = "day") -> DataFrame:
    """Adds ``prev_<column>``: the values of the key's preceding row.

    Works on time chunks: a window inside each (key, chunk), and for the first row of a
    chunk the last row of the key's preceding chunk, found among one row per chunk. No
    task sees more of a key's history than one chunk. ``ts`` must be unique within a key; null
    keys and times are values, and a row without a time comes before all others of its key.
    """
    chunked = df.withColumn("_chunk", F.date_trunc(unit, F.col(ts)))
    inside = Window.partitionBy(key, "_chunk").orderBy(ts)
    state = F.struct(*columns)
    stepped = chunked.withColumn("_prev", F.lag(state).over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    last_rows = chunked.groupBy(key, "_chunk").agg(F.max(F.struct(F.col(ts).isNotNull().alias("_has"), F.col(ts).alias("_at"), state.alias("_row")))["_row"].alias("_last"))
    carried = last_rows.select(
        F.col(key).alias("_key"), F.col("_chunk").alias("_of"), F.lag("_last").over(Window.partitionBy(key).orderBy("_chunk")).alias("_carried")
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_chunk").eqNullSafe(F.col("_of"))
    joined = stepped.join(carried, same, "left")
    before = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_prev"))
    return joined.select(
        *df.columns,
        (before.isNotNull()).alias("has_prev"),
        *[before.getField(c).alias(f"prev_{c}") for c in columns],
    )


def scd2_changes(snapshots: DataFrame, key: str, ts: str, metrics: list[str], ties: list | None = None) -> DataFrame:
    """History reduced to rows where some metric differs from the one before."""
    once = first_per_key(snapshots, [key, ts], ties)
    changed = ~F.col("has_prev")
    for m in metrics:
        changed = changed | ~F.col(m).eqNullSafe(F.col(f"prev_{m}"))
    return previous_in_time(once, key, ts, metrics).filter(changed).select(*once.columns)


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def snapshot_per_day(df: DataFrame, key: str, ts: str, ties: list | None = None) -> DataFrame:
    """Last state of each key on each date, the grain of a date-partitioned append."""
    dated = df.withColumn("snapshot_date", F.col(ts).cast("date").cast("string"))
    return latest_per_key(dated, [key, "snapshot_date"], ts, ties)


def first_seen_per_run(df: DataFrame, key: str, ts: str, unit: str = "day") -> DataFrame:
    """How many keys each run brought for the first time."""
    seen = df.groupBy(key).agg(F.min(F.date_trunc(unit, F.col(ts))).alias("first_load"))
    return seen.groupBy("first_load").agg(F.count("*").alias("new_keys"))


def activity_per_run(df: DataFrame, ts: str, unit: str = "day") -> DataFrame:
    return df.groupBy(F.date_trunc(unit, F.col(ts)).alias("load_ts")).agg(F.count("*").alias("n"))


def run_summary(before: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Counters of one run: rows before, new and refreshed keys, rows after."""
    known = before.select(*keys).distinct().withColumn("_known", F.lit(True))
    counted = (
        first_per_key(batch.select(*keys), keys)
        .join(known, keys, "left")
        .agg(
            F.count_if(F.col("_known").isNull()).alias("new_rows"),
            F.count_if(F.col("_known").isNotNull()).alias("refreshed_rows"),
        )
    )
    prior = before.agg(F.count("*")).scalar()
    return counted.select(
        prior.alias("rows_before"), "new_rows", "refreshed_rows", (prior + F.col("new_rows")).alias("rows_after")
    )


def restrict_to(df: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """Rows of a secondary feed whose key is in scope. ``df`` may repeat a key heavily."""
    return skew_join(df, allowed.select(key).distinct(), [key], "left_semi")


def select_people(cast: DataFrame, crew: DataFrame, key_jobs: list[str], max_order: int = 10) -> DataFrame:
    """People worth fetching: billed within ``max_order`` or holding a key job.
    A missing billing position counts as far down the list."""
    billed = cast.filter(F.coalesce(F.col("cast_order"), F.lit(999)) <= max_order).select("person_id")
    key = crew.filter(F.col("job").isin(key_jobs)).select("person_id")
    return billed.union(key).distinct()


def latest_values(df: DataFrame, key: str, ts: str, k: int, ties: list) -> DataFrame:
    """Newest ``k`` rows per key."""
    return top_per_group(df, [key], [F.col(ts).desc(), *ties], k)
