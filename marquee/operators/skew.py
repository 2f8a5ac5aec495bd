"""Keeping one hot key from landing in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets of a hot key whose count isn't known.
SALTS = 32
# Keys with fewer rows than this are never worth splitting.
HOT_ROWS = 100_000
# Rows that lists unfold to in one task.
UNFOLDED = 1_000_000


class HotKeys(list):
    """Hot values of a key and over how many buckets the rows of each are dealt: as many as
    bring a bucket down to ``HOT_ROWS`` rows, two at least."""

    def __init__(self, counts: dict):
        super().__init__(counts)
        self.salts = {key: max(2, -(-rows // HOT_ROWS)) for key, rows in counts.items()}


def _salts(key: str, hot: list, salts: int) -> Column:
    """Buckets of the row's key."""
    known = getattr(hot, "salts", {})
    pairs = [F.lit(x) for k, n in known.items() if k is not None for x in (k, n)]
    of_value = F.element_at(F.create_map(*pairs), F.col(key)) if pairs else F.lit(None).cast("int")
    return F.when(F.col(key).isNull(), F.lit(known.get(None, salts))).otherwise(F.coalesce(of_value, F.lit(salts)))


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> HotKeys:
    """The most frequent values of a key column, at most four per shuffle partition.

    A value outside the top ``H`` holds at most ``1/H`` of the rows, i.e. a quarter of an
    average shuffle partition, so this bounded list is all that balancing needs. Runs one
    counting job; call it on stored or checkpointed data.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") >= min_rows)
    return HotKeys({r[key]: r["_rows"] for r in counts.orderBy(F.desc("_rows"), key).limit(4 * partitions).collect()})


def _is_hot(key: str, hot: list) -> Column:
    known = F.col(key).isin([h for h in hot if h is not None])
    return F.col(key).isNull() | known if None in hot else F.coalesce(known, F.lit(False))


def salt_many(df: DataFrame, key: str, hot: list, salts: int = SALTS) -> DataFrame:
    """Adds ``_salt``: rows of hot keys are dealt over their buckets, others get 0."""
    dealt = F.pmod(F.xxhash64(*df.columns), _salts(key, hot, salts)).cast("int")
    return df.withColumn("_salt", F.when(_is_hot(key, hot), dealt).otherwise(F.lit(0)))


def salt_few(df: DataFrame, key: str, hot: list, salts: int = SALTS) -> DataFrame:
    """Adds ``_salt``: rows of hot keys are copied to every bucket, others get 0."""
    every = F.sequence(F.lit(0), _salts(key, hot, salts) - 1)
    return df.withColumn("_salt", F.explode(F.when(_is_hot(key, hot), every).otherwise(F.array(F.lit(0)))))


def skew_join(
    many: DataFrame,
    few: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot: list | None = None,
    null_safe: bool = False,
    salts: int = SALTS,
) -> DataFrame:
    """Equi-join where ``many`` may repeat a key a third of the time and ``few`` holds few
    rows per key. ``how`` is inner, left, left_semi or left_anti.

    ``hot`` lists the values of the first key to split: their rows are dealt over buckets
    on the many side and copied on the few side. Where no list is known the join is left
    to adaptive execution, which splits the partition of a hot key at run time
    (``marquee.session.prepare`` turns that on for every join); the rows are the same.
    """
    salted = bool(hot)
    if salted:
        many, few = salt_many(many, keys[0], hot, salts), salt_few(few, keys[0], hot, salts)
    on = [*keys, "_salt"] if salted else keys
    if not null_safe:
        joined = many.join(few, on, how)
    else:
        renamed = few.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in few.columns])
        match = F.lit(True)
        for k in on:
            match = match & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        joined = many.join(renamed, match, how).drop(*[f"_r_{k}" for k in on])
    return joined.drop("_salt")


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int, rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows of each group. Spark trims every group to ``k`` rows before the
    shuffle (WindowGroupLimit), so a hot group never reaches one task whole."""
    name = rank_col or "_position"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank_col else kept.drop(name)


def dealt_to_unfold(df: DataFrame, key: str | list[str], rows: int) -> DataFrame:
    """``df`` by ``key``, one column or several, over as many partitions as its lists need, which unfold to ``rows`` rows in all. The number is
    given, as adaptive execution goes by bytes before lists unfold and would put too many of them together."""
    return df.repartition(max(1, -(-rows // UNFOLDED)), *([key] if isinstance(key, str) else key))
