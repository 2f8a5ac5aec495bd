"""Read queries of the catalogue, for every film or person at once.

A page for one film is the same result filtered by its id; the filter is pushed down to
the scans. Every ordering ends in a key, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import contains_ci, typed_null, year_text
from ..session import cut_lineage
from .skew import dealt_to_unfold, skew_join, top_per_group

# The job names the pages show.
CREW_JOBS = ["Director", "Screenplay", "Writer", "Director of Photography", "Original Music Composer", "Producer"]
GRAPH_JOBS = ["Director", "Screenplay", "Writer", "Director of Photography", "Original Music Composer"]
BRIDGE_JOBS = ["Director", "Director of Photography", "Original Music Composer", "Editor"]


def catalog_summary(spark: SparkSession, films: DataFrame, people: DataFrame, reviews: DataFrame, genres: DataFrame) -> DataFrame:
    """Six figures side by side, as scalar subqueries."""
    one = spark.range(1)
    return one.select(
        films.agg(F.count("*")).scalar().alias("films"),
        people.agg(F.count("*")).scalar().alias("people"),
        reviews.agg(F.count("*")).scalar().alias("reviews"),
        genres.agg(F.countDistinct("genre_id")).scalar().alias("genres"),
        films.agg(F.min("release_date")).scalar().alias("earliest"),
        films.agg(F.max("release_date")).scalar().alias("latest"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def films_per_year(films: DataFrame, min_votes: int = 200) -> DataFrame:
    kept = films.filter(F.col("release_date").isNotNull() & (F.col("vote_count") >= min_votes))
    return kept.groupBy(F.year("release_date").alias("year")).agg(F.count("*").alias("films")).orderBy("year")


def search_titles(films: DataFrame, term: str, k: int = 24, wildcards: bool = True) -> DataFrame:
    return (
        films.filter(contains_ci("title", term, wildcards))
        .select("film_id", "title", "release_date", "vote_average", "vote_count", "poster_path")
        .orderBy(F.desc("vote_count"), "film_id")
        .limit(k)
    )


def profile_core(films: DataFrame, bridge: DataFrame) -> DataFrame:
    return films.join(bridge, "film_id", "left")


def profile_genres(film_genres: DataFrame, genres: DataFrame) -> DataFrame:
    return film_genres.join(genres, "genre_id").select("film_id", "genre_name")


def profile_cast(cast: DataFrame, people: DataFrame, k: int = 12) -> DataFrame:
    """Top of the billing. The cut comes before the names, which then join few rows."""
    billed = top_per_group(cast, ["film_id"], [F.col("cast_order").asc_nulls_last(), F.col("person_id"), F.col("character")], k, "position")
    return skew_join(billed, people.select("person_id", "name"), ["person_id"]).select(
        "film_id", "position", "cast_order", "character", "person_id", "name"
    )


def job_rank(job: Column) -> Column:
    return F.when(job == "Director", 1).when(job == "Screenplay", 2).otherwise(3)


def profile_crew(crew: DataFrame, people: DataFrame, jobs: list[str] = CREW_JOBS) -> DataFrame:
    """Key crew with its display order; order by ``job_rank`` within a film."""
    wanted = crew.filter(F.col("job").isin(jobs)).select("film_id", "person_id", "job")
    named = skew_join(wanted, people.select("person_id", "name"), ["person_id"])
    return named.select("film_id", job_rank(F.col("job")).alias("job_rank"), "job", "person_id", "name")


def profile_reviews(reviews: DataFrame, k: int = 5) -> DataFrame:
    newest = [F.col("created_at").desc_nulls_last(), F.col("review_id")]
    latest = top_per_group(reviews, ["film_id"], newest, k, "position")
    return latest.select("film_id", "position", "author", "author_rating", "content", "created_at")


def metric_history(history: DataFrame) -> DataFrame:
    return history.select("film_id", "snapshot_ts", "revenue", "popularity", "vote_count").orderBy("film_id", "snapshot_ts")


def rating_history(ratings: DataFrame, bridge: DataFrame) -> DataFrame:
    return (
        ratings.join(bridge, "tconst")
        .select("film_id", "snapshot_date", "averageRating", "numVotes")
        .orderBy("film_id", "snapshot_date")
    )


def alternate_titles(akas: DataFrame, bridge: DataFrame, k: int = 8) -> DataFrame:
    """Titles with a region, the original one first."""
    original = F.coalesce(F.col("isOriginalTitle").try_cast("boolean"), F.lit(False))
    regional = akas.filter(F.col("region").isNotNull()).withColumnRenamed("titleId", "tconst").join(bridge, "tconst")
    order = [F.when(original, 0).otherwise(1), F.col("ordering").try_cast("int"), F.col("title"), F.col("region"), F.col("language")]
    return top_per_group(regional, ["film_id"], order, k, "position").select(
        "film_id", "position", "title", "region", "language", "isOriginalTitle"
    )


def filmography(crew: DataFrame, cast: DataFrame, films: DataFrame, k: int = 10, min_votes: int = 200) -> DataFrame:
    """Newest films of each person, from both sides of the camera."""
    # Only one side has a job, so no credit is in both and each side is freed of repeats on its own.
    behind = crew.filter(F.col("job").isin(CREW_JOBS)).select("film_id", "person_id", "job").distinct()
    before = cast.select("film_id", "person_id", "character").distinct()
    credits = behind.unionByName(before, allowMissingColumns=True)
    voted = films.filter(F.col("vote_count") >= min_votes).select("film_id", "title", "release_date")
    # A task holds its films, of which there are far fewer than credits; the credits stream past unsorted.
    rows = skew_join(credits, voted.hint("shuffle_hash"), ["film_id"])
    order = [
        F.col("release_date").desc_nulls_last(),
        F.col("film_id"),
        F.col("job").asc_nulls_last(),
        F.col("character").asc_nulls_last(),
    ]
    return top_per_group(rows, ["person_id"], order, k, "position").select(
        "person_id", "position", "film_id", "title", "release_date", "job", "character"
    )


def neighbourhood(
    films: DataFrame, film_genres: DataFrame, genres: DataFrame, cast: DataFrame, crew: DataFrame, people: DataFrame
) -> DataFrame:
    """What surrounds each film, in one typed list: genres, top cast and key crew."""
    scope = films.select("film_id")
    genre = film_genres.join(genres, "genre_id").select(
        "film_id", F.lit("genre").alias("kind"), F.col("genre_id").cast("string").alias("item_id"),
        F.col("genre_name").alias("label"), typed_null("string").alias("role"),
    )
    top_cast = profile_cast(cast, people, 10).select(
        "film_id", F.lit("cast").alias("kind"), F.col("person_id").cast("string").alias("item_id"),
        F.col("name").alias("label"), F.col("character").alias("role"),
    )
    key_crew = profile_crew(crew, people, GRAPH_JOBS).select(
        "film_id", F.lit("crew").alias("kind"), F.col("person_id").cast("string").alias("item_id"),
        F.col("name").alias("label"), F.col("job").alias("role"),
    )
    return genre.unionByName(top_cast).unionByName(key_crew).join(scope, "film_id", "left_semi")


# ---- films connected through something they share ------------------------------------
#
# A person, source or genre may be shared by a third of all films, so films that share it
# are never paired. Each list ends after k films, and a film's own entry can take at most
# one place, so the first k + 1 films of a shared thing hold every neighbour it can give.


def leading_films(df: DataFrame, keys: list[str], order: list, k: int, fields: list[str]) -> DataFrame:
    """First ``k`` rows per key as a sorted array ``leading``; at most ``k`` rows meet."""
    top = top_per_group(df, keys, order, k, "_position")
    packed = F.array_sort(F.collect_list(F.struct("_position", *fields)))
    return top.groupBy(*keys).agg(packed.alias("leading"))


def related_by_genre(films: DataFrame, film_genres: DataFrame, k: int = 15, min_votes: int = 500) -> DataFrame:
    """Most voted films that share a genre with each film."""
    voted = films.filter(F.col("vote_count") >= min_votes).select("film_id", "title", "vote_count")
    tagged = cut_lineage(film_genres.select("film_id", "genre_id").distinct())
    lists = leading_films(
        tagged.join(voted, "film_id"), ["genre_id"], [F.desc("vote_count"), F.col("film_id")], k + 1, ["film_id", "title", "vote_count"]
    )
    # The lists unfold at the film they are for, so a genre of very many films is no task's.
    met = skew_join(tagged.select(F.col("film_id").alias("center_id"), "genre_id").filter("center_id is not null"), lists, ["genre_id"])
    reached = (
        dealt_to_unfold(met.select("center_id", "leading"), "center_id", tagged.count() * (k + 1))
        .select("center_id", F.explode("leading").alias("f"))
        .select("center_id", "f.film_id", "f.title", "f.vote_count")
        .filter("film_id != center_id")
        .distinct()
    )
    return top_per_group(reached, ["center_id"], [F.desc("vote_count"), F.col("film_id")], k, "position")


def crew_connections(
    crew: DataFrame,
    people: DataFrame,
    films: DataFrame,
    bridge: DataFrame,
    k: int = 5,
    min_votes: int = 200,
    row_limit: int | None = None,
    about_people: tuple[str, ...] = (),
) -> DataFrame:
    """Each film's bridging crew and, per crew member, their ``k`` best other films.

    ``row_limit`` reproduces a cap on a film's rows in person order before the per-person
    cut (150 on the page), which drops later people; ``None`` keeps everyone. ``about_people``
    names further columns of the people, such as the path of their picture.
    """
    eligible = (
        films.filter(F.col("vote_count") >= min_votes)
        .join(bridge.select(F.col("tconst").alias("imdb_id")).distinct(), "imdb_id", "left_semi")
        .select("film_id", "title", "release_date", "vote_average")
    )
    credited = crew.select("person_id", "film_id").distinct()
    worked_on = skew_join(credited, eligible, ["film_id"])
    lists = leading_films(
        worked_on, ["person_id"], [F.desc("vote_average"), F.col("film_id")], k + 1, ["film_id", "title", "release_date", "vote_average"]
    )
    if row_limit is not None:
        lists = lists.join(worked_on.groupBy("person_id").agg(F.count("*").alias("_films")), "person_id")
    about = lists.join(people.select("person_id", "name", *about_people), "person_id")
    centers = (
        crew.filter(F.col("job").isin(BRIDGE_JOBS))
        .groupBy(F.col("film_id").alias("center_id"), "person_id")
        .agg(F.min("job").alias("role"))
    )
    linked = skew_join(centers, about, ["person_id"])
    others = F.filter("leading", lambda f: f["film_id"] != F.col("center_id"))
    if row_limit is None:
        shown = linked.withColumn("_others", F.slice(others, 1, k))
    else:
        own = eligible.select(F.col("film_id").alias("center_id"), F.lit(1).alias("_own"))
        counted = linked.join(own, "center_id", "left").withColumn("_rows", F.col("_films") - F.coalesce("_own", F.lit(0)))
        # Everyone left has a row, so only the first row_limit people of a film can be reached.
        first = top_per_group(counted.filter("_rows > 0"), ["center_id"], [F.col("person_id")], row_limit)
        before = F.sum("_rows").over(Window.partitionBy("center_id").orderBy("person_id").rowsBetween(Window.unboundedPreceding, -1))
        room = F.lit(row_limit) - F.coalesce("_before", F.lit(0))
        shown = (
            first.withColumn("_before", before)
            .filter(room > 0)
            .withColumn("_others", F.slice(others, F.lit(1), F.least(F.lit(k), room).cast("int")))
        )
    return shown.select(
        "center_id",
        "person_id",
        F.col("name").alias("person_name"),
        "role",
        *about_people,
        F.explode("_others").alias("f"),
    ).select(
        "center_id",
        "person_id",
        "person_name",
        "role",
        *about_people,
        F.col("f.film_id").alias("film_id"),
        F.col("f.title").alias("title"),
        year_text("f.release_date").alias("year"),
        F.col("f.vote_average").alias("vote_average"),
    )


def nested_by(df: DataFrame, keys: list[str], fields: list[str], out: str, order: list[str]) -> DataFrame:
    """Rows of each parent as one sorted array, for result documents. Meant for lists
    already cut to a display size."""
    packed = F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order])))
    return df.groupBy(*keys).agg(packed.alias(out))


def co_adaptations(based_on: DataFrame, films: DataFrame, k: int = 60) -> DataFrame:
    """Other films made from the same source material, by source then year."""
    known = films.select(F.col("tconst").alias("imdb_id"), F.col("id").alias("film_id"), "title", "year")
    adapted = cut_lineage(based_on.select("imdb_id", "source_wikidata_id", "source_label").distinct().join(known, "imdb_id"))
    by_year = [F.col("year").asc_nulls_last(), F.col("film_id")]
    once = adapted.select("source_wikidata_id", "film_id", "title", "year").distinct()
    lists = leading_films(once, ["source_wikidata_id"], by_year, k + 1, ["film_id", "title", "year"])
    centers = adapted.select(F.col("film_id").alias("center_id"), "source_wikidata_id", "source_label").filter("center_id is not null")
    reached = (
        dealt_to_unfold(skew_join(centers, lists, ["source_wikidata_id"]), "center_id", adapted.count() * (k + 1))
        .select("center_id", "source_wikidata_id", "source_label", F.explode("leading").alias("f"))
        .select("center_id", "source_wikidata_id", "source_label", "f.film_id", "f.title", "f.year")
        .filter("film_id != center_id")
    )
    order = [F.col("source_label"), *by_year, F.col("source_wikidata_id")]
    return top_per_group(reached, ["center_id"], order, k, "position")


# ---- analytics pages --------------------------------------------------------------


def top_films(leaderboard: DataFrame, films: DataFrame, rank: str, where: Column | None = None, k: int = 24) -> DataFrame:
    """Head of a leaderboard with the poster; posters are looked up for ``k`` films only."""
    board = leaderboard if where is None else leaderboard.filter(where)
    head = board.orderBy(rank, "film_id").limit(k)
    posters = films.select("film_id", "poster_path").join(F.broadcast(head.select("film_id")), "film_id", "left_semi")
    return head.join(posters, "film_id", "left").orderBy(rank, "film_id")


def top_rated(leaderboard: DataFrame, films: DataFrame, min_votes: int = 500) -> DataFrame:
    return top_films(leaderboard, films, "rank_combined_rating", F.col("imdb_votes") >= min_votes)


def top_revenue(leaderboard: DataFrame, films: DataFrame) -> DataFrame:
    return top_films(leaderboard, films, "rank_revenue", F.col("revenue") > 0)


def top_popular(leaderboard: DataFrame, films: DataFrame) -> DataFrame:
    return top_films(leaderboard, films, "rank_popularity")


def top_people(leaderboard: DataFrame, sort_key: str = "rank_film_count", fetch: int = 50, show: int = 25) -> DataFrame:
    """The busiest people, re-sorted by the chosen rank and cut to the table's length."""
    head = leaderboard.orderBy("rank_film_count", "person_id").limit(fetch)
    return head.orderBy(sort_key, "person_id").limit(show)


def yearly_trends(summary: DataFrame, first: int = 2000, last: int = 2025) -> DataFrame:
    return summary.filter(F.col("year").between(first, last)).orderBy("year")
