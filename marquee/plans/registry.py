"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from ..sources.readers import table
from .stage import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Given tables and catalogue views of one folder, by attribute."""

    _given = (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
    ).split()

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self._given:
            return table(self.spark, self.folder, name)
        return view(self.spark, self.folder, name)


def query(sql: str | None = None, views: str = "", name: str | None = None):
    """Registers a function of ``Tables`` under its own name. Without SQL the query is
    checked by the tests instead."""

    def register(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(prepare(spark), folder))
        if sql is not None:
            ORACLES[key] = with_views(views, sql) if views else sql
        return fn

    return register


def load_all() -> None:
    from . import catalog_queries, flatten_queries, graph_queries, load_queries, mart_queries, page_queries, quality_queries, stream_queries  # noqa: F401
