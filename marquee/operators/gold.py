"""Marts: leaderboards, trends and the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import known_money, mean_of_known, profit
from .dedup import first_per_key
from .ranking import add_ranks
from .skew import skew_join

DIRECTOR = "Director"


def film_facts(unified: DataFrame) -> DataFrame:
    """Per-film measures shared by the marts. ``combined_rating`` is the mean of the known
    ratings; money of zero means unknown."""
    return unified.select(
        "film_id",
        "title",
        "year",
        mean_of_known("imdb_rating", "tmdb_rating").alias("combined_rating"),
        "imdb_rating",
        "tmdb_rating",
        "imdb_votes",
        "tmdb_votes",
        known_money("revenue").alias("revenue"),
        profit("revenue", "budget").alias("profit"),
        "popularity",
    )


def film_leaderboard(unified: DataFrame) -> DataFrame:
    return add_ranks(
        film_facts(unified),
        {"rank_combined_rating": "combined_rating", "rank_revenue": "revenue", "rank_popularity": "popularity"},
    )


def genre_trends(unified: DataFrame, film_genres: DataFrame, genres: DataFrame) -> DataFrame:
    facts = film_facts(unified).select("film_id", "year", "combined_rating", "revenue")
    named = film_genres.join(genres, "genre_id").select("film_id", F.col("genre_name").alias("genre"))
    return (
        facts.join(named, "film_id")
        .groupBy("genre", "year")
        .agg(
            F.count("*").alias("film_count"),
            F.avg("combined_rating").alias("avg_combined_rating"),
            F.sum("revenue").alias("total_revenue"),
        )
    )


def yearly_summary(unified: DataFrame) -> DataFrame:
    return (
        film_facts(unified)
        .groupBy("year")
        .agg(
            F.count("*").alias("film_count"),
            F.avg("combined_rating").alias("avg_combined_rating"),
            F.avg("imdb_rating").alias("avg_imdb_rating"),
            F.avg("tmdb_rating").alias("avg_tmdb_rating"),
            F.sum("revenue").alias("total_revenue"),
            F.avg("revenue").alias("avg_revenue"),
            F.avg("popularity").alias("avg_popularity"),
        )
    )


def _people_leaderboard(unified: DataFrame, credits: DataFrame, people: DataFrame) -> DataFrame:
    """One row per person over the distinct films they are credited on. Films are summed
    per person before names are attached, so names join at person grain."""
    facts = film_facts(unified).select("film_id", "combined_rating", "revenue", "popularity")
    per_person = (
        skew_join(credits.select("film_id", "person_id").distinct(), facts, ["film_id"])
        .groupBy("person_id")
        .agg(
            F.count("*").alias("film_count"),
            F.avg("combined_rating").alias("avg_rating"),
            F.sum("revenue").alias("total_revenue"),
            F.avg("popularity").alias("avg_popularity"),
        )
    )
    # Averages are compared at six decimals: the order of addition must not decide a rank.
    rounded = per_person.withColumns({c: F.round(c, 6) for c in ("avg_rating", "avg_popularity")})
    named = rounded.join(people.select("person_id", "name"), "person_id")
    return add_ranks(
        named, {"rank_film_count": "film_count", "rank_avg_rating": "avg_rating", "rank_revenue": "total_revenue"}
    )


def director_leaderboard(unified: DataFrame, crew: DataFrame, people: DataFrame) -> DataFrame:
    return _people_leaderboard(unified, crew.filter(F.col("job") == DIRECTOR), people)


def actor_leaderboard(unified: DataFrame, cast: DataFrame, people: DataFrame) -> DataFrame:
    return _people_leaderboard(unified, cast, people)


def genre_totals(trends: DataFrame) -> DataFrame:
    """All-time roll-up. The rating is the unweighted mean of yearly means."""
    return trends.groupBy("genre").agg(
        F.sum("film_count").alias("films"),
        F.round(F.avg("avg_combined_rating"), 2).alias("avg_rating"),
        F.sum("total_revenue").alias("total_revenue"),
    )


def rating_by_genre(trends: DataFrame, more_than: int = 20) -> DataFrame:
    return genre_totals(trends).filter(F.col("films") > more_than).select("genre", "avg_rating", "films")


# ---- star schema ------------------------------------------------------------------


def surrogate_key(*columns: str) -> Column:
    """Stable 64-bit key of the natural key: no coordination and the same on every run."""
    return F.xxhash64(*columns)


def dim_film(unified: DataFrame) -> DataFrame:
    return unified.select(
        surrogate_key("film_id").alias("film_key"), "film_id", "tconst", "wikidata_id", "title", "original_language", "year"
    )


def dim_person(people: DataFrame) -> DataFrame:
    once = first_per_key(people.select("person_id", "imdb_id", "name"), ["person_id"])
    return once.select(surrogate_key("person_id").alias("person_key"), "*")


def dim_plain(dim: DataFrame, key: str, out: str) -> DataFrame:
    """Genre, company and country dimensions: their rows with a surrogate key in front."""
    return dim.select(surrogate_key(key).alias(out), "*")


def dim_date(dates: DataFrame, date_col: str) -> DataFrame:
    """Calendar without gaps from the first to the last date in use."""
    span = dates.agg(F.min(F.col(date_col).cast("date")).alias("lo"), F.max(F.col(date_col).cast("date")).alias("hi"))
    day = F.col("date")
    return (
        span.filter("lo is not null")
        .select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
        .select(
            (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("date_key"),
            "date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
        )
    )


def _date_key(c: Column) -> Column:
    d = c.cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def fact_film_metrics(history: DataFrame) -> DataFrame:
    return history.select(
        surrogate_key("film_id").alias("film_key"),
        _date_key(F.col("snapshot_ts")).alias("date_key"),
        *[c for c in history.columns if c != "film_id"],
    )


def fact_review(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        surrogate_key("film_id").alias("film_key"),
        _date_key(F.col("created_at")).alias("date_key"),
        "review_id",
        "author",
        "author_rating",
        F.length("content").alias("content_length"),
    )


def fact_release(releases: DataFrame) -> DataFrame:
    return releases.select(
        surrogate_key("film_id").alias("film_key"),
        surrogate_key("country_iso").alias("country_key"),
        _date_key(F.col("release_date")).alias("date_key"),
        "certification",
        "is_primary",
    )


def bridge_keys(bridge: DataFrame, left: str, right: str) -> DataFrame:
    """Bridge of surrogate keys, e.g. film and genre."""
    return bridge.select(
        surrogate_key(left).alias(left.replace("_id", "_key")), surrogate_key(right).alias(right.replace("_id", "_key"))
    ).distinct()
