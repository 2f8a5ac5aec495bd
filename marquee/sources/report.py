"""Row counts and load times of many tables in one result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import typed_null


def table_report(tables: dict[str, DataFrame], ts: dict[str, str] | None = None) -> DataFrame:
    """One row per table: its count and, where a load column is named, its latest value."""
    ts = ts or {}
    out = None
    for name, df in tables.items():
        last = F.max(F.col(ts[name]).cast("timestamp_ntz")) if name in ts else F.max(typed_null("timestamp_ntz"))
        row = df.agg(F.count("*").alias("row_count"), last.alias("last_load")).withColumn("table_name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out.select("table_name", "row_count", "last_load")
