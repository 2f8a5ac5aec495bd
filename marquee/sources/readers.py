"""Landed files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import uri_tail
from .schemas import LINEAGE, SPARQL_RESULT

CORRUPT = "_corrupt_record"
#: Bytes up to which a file is tried as one object over several lines; the lines of larger ones stand for themselves.
WHOLE = 256 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def json_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Schema from the data, which costs a pass of its own; for first looks only."""
    return spark.read.json(path)


def json_enforced(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Fields the files lack are null, fields the schema lacks are dropped. Lineage
    columns of a table schema are left out: they are stamped, not read."""
    if isinstance(schema, T.StructType):
        schema = T.StructType([f for f in schema.fields if f.name not in LINEAGE])
    return spark.read.schema(schema).json(path)


def _landed_bodies(spark: SparkSession, path: str, schema: str, glob: str | None) -> DataFrame:
    """``source_file, row, rejected``: what each landed file holds, or the text that is not an object."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parse = lambda c: F.from_json(c, f"{schema}, {CORRUPT} string", options)
    fine = F.col("row").isNotNull() & F.col("row")[CORRUPT].isNull()
    # The place of a line in its file: the block it was read in and its number there.
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("size"), place.alias("place"), "value")
    lines = lines.filter(F.trim("value") != "").withColumn("row", parse(F.col("value")))
    # A file may be one object over several lines, unless its first line already is one: then the rest is not
    # part of it. Only such files are put together, others stay split as Spark reads them.
    firsts = lines.groupBy("source_file").agg(F.min_by(fine, "place").alias("fine"), F.max("size").alias("size"))
    several = firsts.filter(~F.col("fine") & (F.col("size") <= WHOLE)).select("source_file")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), "\n")
    bodies = lines.join(several, "source_file", "left_semi").groupBy("source_file").agg(body.alias("value")).withColumn("row", parse(F.col("value"))).filter(fine)
    rest = lines.join(bodies.select("source_file"), "source_file", "left_anti")
    found = bodies.select("source_file", "value", "row").unionByName(rest.select("source_file", "value", "row"))
    return found.select("source_file", F.when(fine, F.col("row")).alias("row"), F.when(~fine, F.col("value")).alias("rejected"))


def json_tolerant(spark: SparkSession, path: str, schema: str, glob: str | None = None) -> DataFrame:
    """Rows of landed files, each one object over one or several lines, or one
    object per line; the file is in ``source_file``. Everything is parsed by expressions, so
    every use of the result, a bare count included, sees the same rows. What can't be parsed
    is in ``json_rejected``."""
    return _landed_bodies(spark, path, schema, glob).filter("row is not null").select("source_file", "row.*").drop(CORRUPT)


def json_rejected(spark: SparkSession, path: str, schema: str, glob: str | None = None) -> DataFrame:
    """The lines of the same files that are no object: ``source_file, rejected``, for quarantine."""
    return _landed_bodies(spark, path, schema, glob).filter("rejected is not null").select("source_file", "rejected")


def tsv(spark: SparkSession, path: str, schema: str, keep: Column | None = None, drop: list[str] = ()) -> DataFrame:
    r"""Tab-separated dump, gzipped or not: header, ``\N`` for null, and no quoting, so
    that a stray quote never swallows the lines after it. All columns are text."""
    raw = spark.read.schema(schema).options(sep="\t", header=True, nullValue="", quote="").csv(path)
    # The reader makes empty fields null; only the marker is null here.
    df = raw.select(*[F.when(F.coalesce(c, F.lit("")) != "\\N", F.coalesce(c, F.lit(""))).alias(c) for c in raw.columns])
    if keep is not None:
        df = df.filter(keep)
    return df.drop(*drop)


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_path"))


def files_of_keys(df: DataFrame, keys: DataFrame, key: str, partition: str) -> DataFrame:
    """Rows of the ``partition=value`` folders whose value is a wanted key. The partition is a
    column of the file read, so the keys prune the folders before any file is opened."""
    wanted = keys.select(F.col(key).cast(df.schema[partition].dataType).alias(partition)).distinct()
    return df.join(wanted, partition, "left_semi")



def sparql_bindings(df: DataFrame, text_col: str, fields: dict[str, str], ids: list[str] = ()) -> DataFrame:
    """Rows of a SPARQL result document. ``fields`` maps output names to variables;
    those in ``ids`` hold entity URIs, of which the last segment is kept."""
    parsed = F.from_json(F.col(text_col), SPARQL_RESULT)
    rows = df.select(F.explode(parsed["results"]["bindings"]).alias("b"))
    out = []
    for name, variable in fields.items():
        value = F.col("b")[variable]["value"]
        out.append((uri_tail(value) if name in ids else value).alias(name))
    return rows.select(*out)
