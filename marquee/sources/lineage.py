"""Provenance columns and fitting a batch to an existing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import typed_null


def stamp_bronze(df: DataFrame, system: str, endpoint: str, source_file: Column | str, load_ts: Column | None = None) -> DataFrame:
    """Every landed row records where it came from and when it was loaded."""
    return df.withColumns(
        {
            "source_system": F.lit(system),
            "source_endpoint": F.lit(endpoint),
            "source_file": F.lit(source_file) if isinstance(source_file, str) else source_file,
            "load_ts": F.current_timestamp() if load_ts is None else load_ts,
        }
    )


def stamp_silver(df: DataFrame, system: str, endpoint: str, loaded_at: Column | None = None) -> DataFrame:
    """Like the bronze stamp, keeping an existing source file and adding a null one otherwise."""
    source_file = F.col("source_file") if "source_file" in df.columns else typed_null("string")
    return df.withColumns(
        {
            "source_system": F.lit(system),
            "source_endpoint": F.lit(endpoint),
            "source_file": source_file,
            "loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
        }
    )


def with_constants(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def stringify(df: DataFrame, column: str) -> DataFrame:
    """A column whose nested shape drifts between batches is kept as JSON text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df
    return df.withColumn(column, F.to_json(column))


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """Batch in the target's column order and types: extra columns go, missing ones are
    null, and text that does not parse becomes null."""
    fields = []
    for f in target.fields:
        if f.name not in df.columns:
            value = F.lit(None).cast(f.dataType)
        elif df.schema[f.name].dataType == f.dataType:
            value = F.col(f.name)
        else:
            value = F.col(f.name).try_cast(f.dataType)
        fields.append(value.alias(f.name))
    return df.select(*fields)
