"""One row per key, always by a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import top_per_group


def row_order(df: DataFrame, skip: list[str] = ()) -> list[Column]:
    """A total order over whole rows, so that ties break the same way on every run."""
    return [F.xxhash64(*[c for c in df.columns if c not in skip]).asc()]


def latest_per_key(
    df: DataFrame, keys: list[str], order_by: str | None = "load_ts", ties: list | None = None
) -> DataFrame:
    """Newest row of each key. Null keys form one group, as in SQL grouping.

    Without the order column (a table that was never stamped) one row per key is kept.
    """
    order = []
    if order_by is not None and order_by in df.columns:
        order.append(F.col(order_by).desc_nulls_last())
    order += ties if ties is not None else row_order(df)
    return top_per_group(df, keys, order, 1)


def first_per_key(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """Subset dedup with a stated winner instead of an arbitrary one."""
    return top_per_group(df, keys, order or row_order(df), 1)
