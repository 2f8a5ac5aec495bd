"""Marts, analytics pages and the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import int_or_null
from ..operators import flatten as X
from ..operators import gold as G
from ..operators import quality as Q
from ..operators import resolve as R
from ..operators import serving as V
from ..operators.dedup import latest_per_key
from ..session import cut_lineage
from .quality_queries import _validated_ratings
from .registry import Tables, query

# The marts read one row per film: first-source measures and the latest rating.
_VIEWS = "movies ratings"
_RATED = """valid_ratings AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY tconst, snapshot_date
            ORDER BY cast("numVotes" AS int) DESC, cast("averageRating" AS int) DESC) AS rn FROM ratings)
        WHERE rn = 1 AND cast("averageRating" AS double) BETWEEN 1.0 AND 10.0),
    last_rating AS (SELECT * FROM (SELECT tconst, cast("averageRating" AS double) AS imdb_rating, cast("numVotes" AS bigint) AS imdb_votes,
        row_number() OVER (PARTITION BY tconst ORDER BY snapshot_date DESC) AS rn2 FROM valid_ratings) WHERE rn2 = 1)"""
FACTS = f"""{_RATED}, facts AS (
    SELECT film_id, title, cast(year(release_date) AS int) AS year, imdb_rating, imdb_votes, vote_average AS tmdb_rating, vote_count AS tmdb_votes,
           CASE WHEN imdb_rating IS NOT NULL AND vote_average IS NOT NULL THEN (imdb_rating + vote_average) / 2
                ELSE coalesce(imdb_rating, vote_average) END AS combined_rating,
           CASE WHEN revenue > 0 THEN revenue END AS revenue,
           CASE WHEN revenue > 0 AND budget > 0 THEN revenue - budget END AS profit, popularity
    FROM movies LEFT JOIN last_rating ON tconst = imdb_id)"""


def unified(t: Tables):
    """The columns of the unified table that the marts use."""
    bridge = t.movies.select(F.col("imdb_id").alias("tconst"), "film_id")
    ratings = R.latest_ratings(_validated_ratings(t), bridge).select("film_id", "imdb_rating", "imdb_votes")
    films = t.movies.select(
        "film_id", "title", F.year("release_date").alias("year"), F.col("vote_average").alias("tmdb_rating"),
        F.col("vote_count").alias("tmdb_votes"), "revenue", "budget", "popularity",
    )
    return films.join(ratings, "film_id", "left")


def _rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


_BOARD = """board AS (SELECT *, rank() OVER (ORDER BY combined_rating DESC NULLS LAST) AS rank_combined_rating,
    rank() OVER (ORDER BY revenue DESC NULLS LAST) AS rank_revenue, rank() OVER (ORDER BY popularity DESC NULLS LAST) AS rank_popularity FROM facts)"""
_SCORES = "round(combined_rating, 4) AS combined_rating, imdb_rating, round(tmdb_rating, 4) AS tmdb_rating"


@query(f"""WITH {FACTS}, {_BOARD} SELECT film_id, title, year, {_SCORES}, imdb_votes, tmdb_votes, revenue, profit, popularity,
    rank_combined_rating, rank_revenue, rank_popularity FROM board""", _VIEWS)
def film_leaderboard(t: Tables):
    return _rounded(G.film_leaderboard(unified(t)), "combined_rating", "tmdb_rating")


_TRENDS = """trends_by_genre AS (SELECT upper(genre_id) AS genre, year, count(*) AS film_count, avg(combined_rating) AS avg_combined_rating,
    cast(sum(revenue) AS bigint) AS total_revenue FROM facts JOIN film_genres USING (film_id) GROUP BY ALL)"""


def trends(t: Tables):
    return G.genre_trends(unified(t), t.film_genres, t.genres)


@query(f"""WITH {FACTS}, {_TRENDS} SELECT genre, year, film_count, round(avg_combined_rating, 4) AS avg_combined_rating, total_revenue FROM trends_by_genre""",
       _VIEWS + " film_genres")
def genre_trends(t: Tables):
    return _rounded(trends(t), "avg_combined_rating")


_YEARS = """years AS (SELECT year, count(*) AS film_count, round(avg(combined_rating), 4) AS avg_combined_rating, round(avg(imdb_rating), 4) AS avg_imdb_rating,
    round(avg(tmdb_rating), 4) AS avg_tmdb_rating, cast(sum(revenue) AS bigint) AS total_revenue, round(avg(revenue), 2) AS avg_revenue,
    round(avg(popularity), 4) AS avg_popularity FROM facts GROUP BY year)"""


def years(t: Tables):
    summary = _rounded(G.yearly_summary(unified(t)), "avg_combined_rating", "avg_imdb_rating", "avg_tmdb_rating", "avg_popularity")
    return _rounded(summary, "avg_revenue", digits=2)


@query(f"WITH {FACTS}, {_YEARS} SELECT * FROM years", _VIEWS)
def yearly_summary(t: Tables):
    return years(t)


@query(f"WITH {FACTS}, {_YEARS} SELECT * FROM years WHERE year BETWEEN 2000 AND 2025 ORDER BY year", _VIEWS)
def analytics_years(t: Tables):
    return V.yearly_trends(years(t))


_TOTALS = """SELECT genre, cast(sum(film_count) AS bigint) AS films, round(avg(avg_combined_rating), 2) AS avg_rating,
    cast(sum(total_revenue) AS bigint) AS total_revenue FROM trends_by_genre GROUP BY genre"""


@query(f"WITH {FACTS}, {_TRENDS} {_TOTALS}", _VIEWS + " film_genres")
def genre_rollup(t: Tables):
    return G.genre_totals(trends(t))


@query(f"WITH {FACTS}, {_TRENDS} SELECT genre, avg_rating, films FROM ({_TOTALS}) WHERE films > 250", _VIEWS + " film_genres")
def genre_having(t: Tables):
    return G.rating_by_genre(trends(t), 250)


@query(f"WITH {FACTS}, {_TRENDS} SELECT genre, films, avg_rating, total_revenue, films > 20 AS rated FROM ({_TOTALS}) ORDER BY films DESC",
       _VIEWS + " film_genres")
def analytics_genres(t: Tables):
    return G.genre_totals(trends(t)).withColumn("rated", F.col("films") > 20).orderBy(F.desc("films"))


@query("""
    WITH latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY load_ts DESC, delivery, source, vote_count, popularity, vote_average, revenue) AS rn
        FROM films_raw) WHERE rn = 1 AND id IS NOT NULL),
    yearly AS (SELECT unnest(string_split(title, ' ')) AS genre, year(cast(release_date AS date)) AS year, vote_average, revenue FROM latest),
    trend AS (SELECT genre, year, count(*) AS film_count, avg(vote_average) AS r, sum(revenue) AS total_revenue FROM yearly GROUP BY ALL)
    SELECT genre, cast(sum(film_count) AS bigint) AS films, round(avg(r), 2) AS avg_rating, cast(sum(total_revenue) AS bigint) AS total_revenue
    FROM trend GROUP BY genre HAVING sum(film_count) > 20""", "films_raw")
def genre_rollup_from_raw(t: Tables):
    """From landed snapshots to the genre page in one plan."""
    from .quality_queries import raw_ties

    rules = [Q.Rule("null_id", F.col("id").isNotNull())]
    valid = Q.split(latest_per_key(t.films_raw, ["id"], "load_ts", raw_ties()), rules, "2024-02-01").valid
    tagged = X.exploded(
        valid.withColumn("genres", F.split("title", " ")),
        F.struct("release_date", "vote_average", "revenue").alias("film"), "genres", "genre",
    )
    year = F.year(F.col("film.release_date").try_cast("date"))
    by_year = tagged.groupBy("genre", year.alias("year")).agg(
        F.count("*").alias("film_count"), F.avg("film.vote_average").alias("avg_combined_rating"), F.sum("film.revenue").alias("total_revenue")
    )
    return G.genre_totals(by_year).filter(F.col("films") > 20)


_PEOPLE = """people_facts AS (SELECT person_id, count(*) AS film_count, round(avg(combined_rating), 6) AS avg_rating, cast(sum(revenue) AS bigint) AS total_revenue,
        round(avg(popularity), 6) AS avg_popularity FROM (SELECT DISTINCT film_id, person_id FROM {0}) JOIN facts USING (film_id) GROUP BY person_id),
    leaders AS (SELECT person_id, name, film_count, avg_rating, total_revenue, avg_popularity, rank() OVER (ORDER BY film_count DESC) AS rank_film_count,
        rank() OVER (ORDER BY avg_rating DESC NULLS LAST) AS rank_avg_rating, rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS rank_revenue
        FROM people_facts JOIN people USING (person_id))"""
_DIRECTORS = _PEOPLE.format("film_crew WHERE job = 'Director'")
_ACTORS = _PEOPLE.format("film_cast")


@query(f"WITH {FACTS}, {_DIRECTORS} SELECT * FROM leaders", _VIEWS + " film_crew people")
def director_leaderboard(t: Tables):
    return G.director_leaderboard(unified(t), t.film_crew, t.people)


@query(f"WITH {FACTS}, {_ACTORS} SELECT * FROM leaders", _VIEWS + " film_cast people")
def actor_leaderboard(t: Tables):
    return G.actor_leaderboard(unified(t), t.film_cast, t.people)


_HEAD = "SELECT '{0}' AS page, b.film_id, b.title, b.year, b.revenue, b.{1} AS rank, poster_path FROM (SELECT * FROM board WHERE {2} ORDER BY {1}, film_id LIMIT 24) b LEFT JOIN movies m ON m.film_id = b.film_id"


@query(f"""WITH {FACTS}, {_BOARD} {_HEAD.format('rated', 'rank_combined_rating', 'imdb_votes >= 40')}
    UNION ALL {_HEAD.format('revenue', 'rank_revenue', 'revenue > 0')} UNION ALL {_HEAD.format('popular', 'rank_popularity', 'true')}""", _VIEWS)
def analytics_top_films(t: Tables):
    board = cut_lineage(G.film_leaderboard(unified(t)))  # the pages read the stored mart
    pages = {
        "rated": (V.top_rated(board, t.movies, 40), "rank_combined_rating"),
        "revenue": (V.top_revenue(board, t.movies), "rank_revenue"),
        "popular": (V.top_popular(board, t.movies), "rank_popularity"),
    }
    out = None
    for name, (df, rank) in pages.items():
        part = df.select(F.lit(name).alias("page"), "film_id", "title", "year", "revenue", F.col(rank).alias("rank"), "poster_path")
        out = part if out is None else out.unionByName(part)
    return out


_TABLE = """SELECT '{0}' AS sort_key, person_id, name, film_count, {0} AS rank FROM (
    SELECT * FROM (SELECT * FROM leaders ORDER BY rank_film_count, person_id LIMIT 50) ORDER BY {0}, person_id LIMIT 25)"""


@query(f"WITH {FACTS}, {_DIRECTORS} " + " UNION ALL ".join(_TABLE.format(k) for k in ("rank_film_count", "rank_avg_rating", "rank_revenue")),
       _VIEWS + " film_crew people")
def analytics_people(t: Tables):
    board = cut_lineage(G.director_leaderboard(unified(t), t.film_crew, t.people))
    out = None
    for key in ("rank_film_count", "rank_avg_rating", "rank_revenue"):
        part = V.top_people(board, key).select(F.lit(key).alias("sort_key"), "person_id", "name", "film_count", F.col(key).alias("rank"))
        out = part if out is None else out.unionByName(part)
    return out


@query(f"WITH {FACTS}, {_ACTORS} " + " UNION ALL ".join(_TABLE.format(k) for k in ("rank_film_count", "rank_avg_rating", "rank_revenue")),
       _VIEWS + " film_cast people")
def analytics_actors(t: Tables):
    board = cut_lineage(G.actor_leaderboard(unified(t), t.film_cast, t.people))
    parts = [V.top_people(board, key).select(F.lit(key).alias("sort_key"), "person_id", "name", "film_count", F.col(key).alias("rank")) for key in ("rank_film_count", "rank_avg_rating", "rank_revenue")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- star schema -------------------------------------------------------------------------


@query("""SELECT cast(strftime(d, '%Y%m%d') AS int) AS date_key, cast(cast(d AS date) AS string) AS date, cast(year(d) AS int) AS year, cast(quarter(d) AS int) AS quarter,
        cast(month(d) AS int) AS month, cast(day(d) AS int) AS day
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)""")
def star_dim_date(t: Tables):
    return G.dim_date(t.orders, "o_orderdate").withColumn("date", F.col("date").cast("string"))


@query("""SELECT cast(strftime(snapshot_ts, '%Y%m%d') AS int) AS date_key, count(*) AS n, count(DISTINCT film_id) AS films, sum(revenue)::bigint AS revenue
    FROM trends GROUP BY 1""", "trends")
def star_fact(t: Tables):
    fact = G.fact_film_metrics(t.trends.select("film_id", "snapshot_ts", "revenue"))
    return fact.groupBy("date_key").agg(
        F.count("*").alias("n"), F.countDistinct("film_key").alias("films"), F.sum("revenue").alias("revenue")
    )


@query("""SELECT film_id, count(*) AS links, count(*) = count(DISTINCT genre_id) AS unique_keys FROM film_genres GROUP BY film_id""", "film_genres")
def star_bridge(t: Tables):
    """Fact and dimensions meet on surrogate keys and give back the natural ones."""
    films = G.dim_film(t.movies.select("film_id", F.col("imdb_id").alias("tconst"), F.lit(None).cast("string").alias("wikidata_id"),
                                       "title", F.lit("en").alias("original_language"), F.year("release_date").alias("year")))
    genres = G.dim_plain(t.genres, "genre_id", "genre_key")
    linked = G.bridge_keys(t.film_genres, "film_id", "genre_id").join(films, "film_key").join(genres, "genre_key")
    return linked.groupBy("film_id").agg(F.count("*").alias("links"), (F.count("*") == F.countDistinct("genre_id")).alias("unique_keys"))


@query("""SELECT count(*) AS people, count(DISTINCT person_id) AS keys FROM people""", "people")
def star_dim_person(t: Tables):
    return G.dim_person(t.people).agg(F.count("*").alias("people"), F.countDistinct("person_key").alias("keys"))


@query("""SELECT author, count(*) AS n, sum(length(content))::bigint AS letters, max(author_rating) AS top FROM film_reviews GROUP BY author""", "film_reviews")
def star_fact_review(t: Tables):
    dated = t.film_reviews.withColumn("created_at", F.date_add(F.lit("2024-01-01").cast("date"), int_or_null("created_at")))
    fact = G.fact_review(dated)
    return fact.groupBy("author").agg(F.count("*").alias("n"), F.sum("content_length").alias("letters"), F.max("author_rating").alias("top"))
