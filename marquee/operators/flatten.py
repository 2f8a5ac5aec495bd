"""From nested source records to dimensions, bridges and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    bool_or_null,
    double_or_null,
    empty_to_null,
    int_or_null,
    long_or_null,
    to_date10,
    to_timestamp_or_null,
    typed_null,
)
from .dedup import first_per_key


def project(df: DataFrame, fields: dict[str, Column], keys: list[str]) -> DataFrame:
    """Typed projection with one row per key."""
    return first_per_key(df.select(*[c.alias(n) for n, c in fields.items()]), keys)


def exploded(df: DataFrame, owner: Column, array: str, alias: str = "item") -> DataFrame:
    return df.select(owner, F.explode(array).alias(alias))


def dim_and_bridge(
    df: DataFrame, owner: Column, array: str, dim: dict[str, Column], dim_key: str, owner_name: str
) -> tuple[DataFrame, DataFrame]:
    """Dimension and bridge from one exploded array column; fields refer to ``item``."""
    items = exploded(df, owner, array)
    dimension = project(items, dim, [dim_key])
    bridge = items.select(owner_name, dim[dim_key].alias(dim_key)).distinct()
    return dimension, bridge


def aliases(df: DataFrame, owner: Column, array: str, owner_name: str) -> DataFrame:
    """Non-blank distinct aliases; owners without any simply have no row."""
    out = df.select(owner, F.explode(array).alias("alias"))
    return out.filter(F.trim("alias") != "").dropDuplicates([owner_name, "alias"])


def conform(key: str, label: str, *sources: DataFrame) -> DataFrame:
    """One dimension from several sources, keeping any known label."""
    united = sources[0].select(key, label)
    for s in sources[1:]:
        united = united.unionByName(s.select(key, label))
    return united.groupBy(key).agg(F.max(label).alias(label)).filter(F.col(key).isNotNull())


# ---- first-source documents -------------------------------------------------------


def films(raw: DataFrame) -> DataFrame:
    return project(
        raw,
        {
            "film_id": long_or_null("id"),
            "imdb_id": empty_to_null("imdb_id"),
            "title": F.col("title"),
            "original_title": F.col("original_title"),
            "original_language": F.col("original_language"),
            "status": F.col("status"),
            "release_date": to_date10("release_date"),
            "runtime": int_or_null("runtime"),
            "budget": long_or_null("budget"),
            "revenue": long_or_null("revenue"),
            "popularity": double_or_null("popularity"),
            "vote_average": double_or_null("vote_average"),
            "vote_count": int_or_null("vote_count"),
            "adult": bool_or_null("adult"),
            "video": bool_or_null("video"),
            "homepage": empty_to_null("homepage"),
            "tagline": empty_to_null("tagline"),
            "overview": F.col("overview"),
            "collection_id": long_or_null(F.get_json_object("belongs_to_collection", "$.id")),
            "collection_name": F.get_json_object("belongs_to_collection", "$.name"),
            "poster_path": F.col("poster_path"),
            "backdrop_path": F.col("backdrop_path"),
        },
        ["film_id"],
    )


def people(raw: DataFrame) -> DataFrame:
    return project(
        raw,
        {
            "person_id": long_or_null("id"),
            "imdb_id": empty_to_null("imdb_id"),
            "name": F.col("name"),
            "gender": int_or_null("gender"),
            "birthday": to_date10("birthday"),
            "deathday": to_date10("deathday"),
            "known_for_department": F.col("known_for_department"),
            "place_of_birth": empty_to_null("place_of_birth"),
            "popularity": double_or_null("popularity"),
            "biography": F.col("biography"),
            "profile_path": F.col("profile_path"),
        },
        ["person_id"],
    )


def _film_id() -> Column:
    return long_or_null("id").alias("film_id")


def film_cast(credits: DataFrame) -> DataFrame:
    item = {
        "credit_id": F.col("item.credit_id"),
        "film_id": F.col("film_id"),
        "person_id": long_or_null("item.id"),
        "character": F.col("item.character"),
        "cast_order": int_or_null("item.order"),
        "cast_id": int_or_null("item.cast_id"),
    }
    return project(exploded(credits, _film_id(), "cast"), item, ["credit_id"])


def film_crew(credits: DataFrame) -> DataFrame:
    item = {
        "credit_id": F.col("item.credit_id"),
        "film_id": F.col("film_id"),
        "person_id": long_or_null("item.id"),
        "department": F.col("item.department"),
        "job": F.col("item.job"),
    }
    return project(exploded(credits, _film_id(), "crew"), item, ["credit_id"])


def genres(films_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    dim = {"genre_id": int_or_null("item.id"), "genre_name": F.col("item.name")}
    return dim_and_bridge(films_raw, _film_id(), "genres", dim, "genre_id", "film_id")


def companies(films_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    dim = {
        "company_id": long_or_null("item.id"),
        "company_name": F.col("item.name"),
        "origin_country": empty_to_null("item.origin_country"),
        "logo_path": F.col("item.logo_path"),
    }
    return dim_and_bridge(films_raw, _film_id(), "production_companies", dim, "company_id", "film_id")


def languages(films_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    dim = {
        "language_iso": F.col("item.iso_639_1"),
        "language_name": F.col("item.name"),
        "english_name": F.col("item.english_name"),
    }
    return dim_and_bridge(films_raw, _film_id(), "spoken_languages", dim, "language_iso", "film_id")


def film_countries(films_raw: DataFrame) -> DataFrame:
    items = exploded(films_raw, _film_id(), "production_countries")
    return items.select("film_id", F.col("item.iso_3166_1").alias("country_iso")).distinct()


def countries(films_raw: DataFrame, releases_raw: DataFrame) -> DataFrame:
    """Country dimension from productions (named) and releases (code only)."""
    produced = exploded(films_raw, _film_id(), "production_countries").select(
        F.col("item.iso_3166_1").alias("country_iso"), F.col("item.name").alias("country_name")
    )
    released = exploded(releases_raw, _film_id(), "countries").select(
        F.col("item.iso_3166_1").alias("country_iso"), typed_null("string").alias("country_name")
    )
    return conform("country_iso", "country_name", produced, released)


RELEASE_KEY = ["film_id", "country_iso", "release_date", "certification"]


def film_releases(releases_raw: DataFrame) -> DataFrame:
    """Natural key of four columns, two of which may be null and still equal themselves."""
    item = {
        "film_id": F.col("film_id"),
        "country_iso": F.col("item.iso_3166_1"),
        "certification": empty_to_null("item.certification"),
        "release_date": to_date10("item.release_date"),
        "is_primary": bool_or_null("item.primary"),
        "release_type": typed_null("int"),
        "descriptors": F.col("item.descriptors"),
    }
    return project(exploded(releases_raw, _film_id(), "countries"), item, RELEASE_KEY)


def film_reviews(reviews_raw: DataFrame) -> DataFrame:
    item = {
        "review_id": F.col("item.id"),
        "film_id": F.col("film_id"),
        "author": F.col("item.author"),
        "author_username": F.col("item.author_details.username"),
        "author_rating": double_or_null("item.author_details.rating"),
        "content": F.col("item.content"),
        "created_at": to_timestamp_or_null("item.created_at"),
        "updated_at": to_timestamp_or_null("item.updated_at"),
        "url": F.col("item.url"),
    }
    return project(exploded(reviews_raw, _film_id(), "results"), item, ["review_id"])


def metric_snapshots(films_raw: DataFrame) -> DataFrame:
    """Rows of the metric history, one per landed snapshot."""
    return films_raw.select(
        long_or_null("id").alias("film_id"),
        double_or_null("popularity").alias("popularity"),
        double_or_null("vote_average").alias("vote_average"),
        int_or_null("vote_count").alias("vote_count"),
        long_or_null("revenue").alias("revenue"),
        long_or_null("budget").alias("budget"),
        F.col("load_ts").alias("snapshot_ts"),
    )
