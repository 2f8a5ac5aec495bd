"""Sinks. Nothing is counted by scanning the data again: counts come from the write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Files that one task writes when each key has its own.
FILES = 100


def append(df: DataFrame, path: str) -> int:
    """Appends and returns the number of rows written, observed during the write."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


def overwrite(df: DataFrame, path: str) -> int:
    """Replaces data and schema. ``df`` must not read from ``path``."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def overwrite_unless_empty(df: DataFrame, path: str) -> bool:
    """Replaces the table only when the delivery has rows; tells whether it did."""
    if df.isEmpty():
        return False
    overwrite(df, path)
    return True


def write_split(valid: DataFrame, quarantine: DataFrame, valid_path: str, quarantine_path: str) -> tuple[int, int]:
    """Replaces the validated table and appends to the quarantine, whose columns may grow."""
    return overwrite(valid, valid_path), append(quarantine, quarantine_path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """A table whose appends brought new columns: the union of all schemas."""
    return spark.read.option("mergeSchema", True).parquet(path)


def land_json(df: DataFrame, path: str, max_records: int = 10_000, partition_by: list[str] = ()) -> None:
    """JSON lines in files of bounded size, optionally one folder per partition value."""
    writer = df.write.mode("append").option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def dealt_by_files(df: DataFrame, key: str) -> DataFrame:
    """``df`` by ``key``, over as many partitions as a file for each value needs. The number is given, as adaptive
    execution goes by bytes and would have one task open the files of very many small keys one after the other."""
    files = df.select(key).distinct().count()
    return df.repartition(max(1, -(-files // FILES)), key)


def land_tsv(df: DataFrame, path: str, gzip: bool = True) -> None:
    r"""Tab-separated dump with ``\N`` for null and no quoting."""
    options = {"sep": "\t", "header": True, "nullValue": "\\N", "quote": "", "emptyValue": ""}
    if gzip:
        options["compression"] = "gzip"
    df.write.mode("append").options(**options).csv(path)


def land_snapshots(df: DataFrame, path: str, date_col: str = "snapshot_date") -> None:
    """Periodic snapshots, pruned by date when read back."""
    df.write.mode("append").partitionBy(date_col).parquet(path)


def resume_load(incoming: DataFrame, path: str, keys: list[str]) -> int:
    """Appends only rows whose key is not landed yet, so an interrupted load can be run
    again from the start in any order."""
    landed = incoming.sparkSession.read.parquet(path).select(*keys)
    return append(incoming.join(landed, keys, "left_anti"), path)


def documents(df: DataFrame, columns: list[str], name: str = "node") -> DataFrame:
    """One JSON object per row, ready for ``write.text``: the list is the file's lines."""
    return df.select(F.to_json(F.struct(*columns)).alias(name))
