"""Pages of the catalogue for every film or person at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import serving as V
from .catalog_queries import FILMS, bridge, films
from .quality_queries import _validated_ratings, micros
from .registry import Tables, query


@query("""SELECT (SELECT count(*) FROM movies) AS films, (SELECT count(*) FROM people) AS people, (SELECT count(*) FROM film_reviews) AS reviews,
    (SELECT count(DISTINCT genre_id) FROM genres) AS genres, cast((SELECT min(release_date) FROM movies) AS string) AS earliest,
    cast((SELECT max(release_date) FROM movies) AS string) AS latest""", "movies people film_reviews genres")
def summary_scalars(t: Tables):
    out = V.catalog_summary(t.spark, t.movies, t.people, t.film_reviews, t.genres)
    return out.withColumns({c: F.col(c).cast("string") for c in ("earliest", "latest")})


@query("SELECT count(*) AS n FROM lineitem")
def row_count(t: Tables):
    return V.row_count(t.lineitem)


@query("""SELECT cast(year(release_date) AS int) AS year, count(*) AS films FROM movies WHERE release_date IS NOT NULL AND vote_count >= 200 GROUP BY 1 ORDER BY 1""", "movies")
def per_year(t: Tables):
    return V.films_per_year(t.movies)


@query("""SELECT film_id, title, cast(release_date AS string) AS release_date, vote_count, poster_path FROM movies WHERE title ILIKE '%Gear%'
    ORDER BY vote_count DESC, film_id LIMIT 24""", "movies")
def search_title(t: Tables):
    found = V.search_titles(t.movies, "Gear").drop("vote_average")
    return found.withColumn("release_date", F.col("release_date").cast("string"))


@query(f"""WITH {FILMS} SELECT m.film_id, m.title, m.vote_count, m.revenue, s.tconst FROM movies m LEFT JOIN spine s ON s.film_id = m.film_id""",
       "movies films_raw basics")
def profile_core(t: Tables):
    return V.profile_core(t.movies, bridge(t)).select("film_id", "title", "vote_count", "revenue", "tconst")


@query("SELECT film_id, genre_name FROM film_genres JOIN genres USING (genre_id)", "film_genres genres")
def profile_genres(t: Tables):
    return V.profile_genres(t.film_genres, t.genres)


@query("""SELECT film_id, cast(rn AS int) AS position, cast_order, character, person_id, name FROM (
    SELECT *, row_number() OVER (PARTITION BY film_id ORDER BY cast_order, person_id, character) AS rn FROM film_cast) JOIN people USING (person_id) WHERE rn <= 12""",
       "film_cast people")
def profile_cast(t: Tables):
    return V.profile_cast(t.film_cast, t.people)


@query("""SELECT film_id, CASE job WHEN 'Director' THEN 1 WHEN 'Screenplay' THEN 2 ELSE 3 END AS job_rank, job, person_id, name
    FROM film_crew JOIN people USING (person_id) WHERE job <> 'Editor'""", "film_crew people")
def profile_crew(t: Tables):
    return V.profile_crew(t.film_crew, t.people)


@query("""SELECT film_id, cast(rn AS int) AS position, author, author_rating, content, created_at FROM (
    SELECT *, row_number() OVER (PARTITION BY film_id ORDER BY created_at DESC, review_id) AS rn FROM film_reviews) WHERE rn <= 5""", "film_reviews")
def profile_reviews(t: Tables):
    return V.profile_reviews(t.film_reviews)


@query("SELECT film_id, epoch_us(snapshot_ts) AS ts_us, revenue, popularity, vote_count FROM trends ORDER BY film_id, snapshot_ts", "trends")
def profile_history(t: Tables):
    return V.metric_history(t.trends).select("film_id", micros("snapshot_ts").alias("ts_us"), "revenue", "popularity", "vote_count")


@query(f"""WITH {FILMS}, v AS (SELECT tconst, snapshot_date, "averageRating", "numVotes" FROM (
        SELECT *, row_number() OVER (PARTITION BY tconst, snapshot_date ORDER BY cast("numVotes" AS int) DESC, cast("averageRating" AS int) DESC) AS rn FROM ratings)
        WHERE rn = 1 AND cast("averageRating" AS double) BETWEEN 1.0 AND 10.0)
    SELECT film_id, snapshot_date, "averageRating", "numVotes" FROM v JOIN spine USING (tconst)""", "films_raw basics ratings")
def rating_history(t: Tables):
    return V.rating_history(_validated_ratings(t), bridge(t))


@query(f"""WITH {FILMS}, a AS (SELECT DISTINCT "titleId", ordering, title, region, language, "isOriginalTitle" FROM akas WHERE region IS NOT NULL)
    SELECT film_id, cast(rn AS int) AS position, title, region, language, "isOriginalTitle" FROM (
        SELECT film_id, a.*, row_number() OVER (PARTITION BY film_id ORDER BY "isOriginalTitle" <> '1', cast(ordering AS int), a.title, region, language) AS rn
        FROM a JOIN spine ON tconst = "titleId") WHERE rn <= 8""", "films_raw basics akas")
def akas_ordered(t: Tables):
    titles = t.akas.select("titleId", "ordering", "title", "region", "language", "isOriginalTitle").distinct()
    return V.alternate_titles(titles, bridge(t))


@query("""WITH c AS (SELECT film_id, person_id, job, NULL::string AS character FROM film_crew WHERE job <> 'Editor'
        UNION SELECT film_id, person_id, NULL, character FROM film_cast),
    r AS (SELECT c.person_id, c.film_id, title, cast(release_date AS string) AS release_date, job, character, row_number() OVER (PARTITION BY person_id
        ORDER BY release_date DESC NULLS LAST, c.film_id, job NULLS LAST, character NULLS LAST) AS rn FROM c JOIN movies m ON m.film_id = c.film_id WHERE vote_count >= 200)
    SELECT person_id, cast(rn AS int) AS position, film_id, title, release_date, job, character FROM r WHERE rn <= 10""", "film_crew film_cast movies")
def person_filmography(t: Tables):
    return filmography(t).withColumn("release_date", F.col("release_date").cast("string"))


def filmography(t: Tables):
    return V.filmography(t.film_crew, t.film_cast, t.movies)


@query("""SELECT film_id, 'genre' AS kind, genre_id AS item_id, genre_name AS label, NULL::string AS role FROM film_genres JOIN genres USING (genre_id)
    UNION ALL SELECT film_id, 'cast', cast(person_id AS string), name, character FROM (
        SELECT *, row_number() OVER (PARTITION BY film_id ORDER BY cast_order, person_id, character) AS rn FROM film_cast) JOIN people USING (person_id) WHERE rn <= 10
    UNION ALL SELECT film_id, 'crew', cast(person_id AS string), name, job FROM film_crew JOIN people USING (person_id)
        WHERE job IN ('Director', 'Screenplay', 'Writer', 'Director of Photography', 'Original Music Composer')""",
       "film_genres genres film_cast film_crew people")
def ego_neighbourhood(t: Tables):
    return V.neighbourhood(t.movies, t.film_genres, t.genres, t.film_cast, t.film_crew, t.people)


@query("""SELECT center_id, film_id, title, vote_count, cast(rn AS int) AS position FROM (
        SELECT center_id, m.film_id, title, vote_count, row_number() OVER (PARTITION BY center_id ORDER BY vote_count DESC, m.film_id) AS rn
        FROM (SELECT DISTINCT a.film_id AS center_id, b.film_id FROM film_genres a JOIN film_genres b USING (genre_id) WHERE a.film_id <> b.film_id) p
        JOIN movies m ON m.film_id = p.film_id WHERE vote_count >= 500) WHERE rn <= 15""", "film_genres movies")
def related_by_genre(t: Tables):
    return related(t)


def related(t: Tables):
    return V.related_by_genre(t.movies, t.film_genres)


def connections(t: Tables, **kw):
    return V.crew_connections(t.film_crew, t.people, t.movies, bridge(t), **kw)


_LINKS = f"""{FILMS}, centers AS (SELECT film_id AS center_id, person_id, min(job) AS role FROM film_crew
        WHERE job IN ('Director', 'Director of Photography', 'Original Music Composer', 'Editor') GROUP BY ALL),
    links AS (SELECT c.*, name AS person_name, m.film_id, m.title, left(cast(m.release_date AS string), 4) AS year, vote_average FROM centers c
        JOIN people USING (person_id) JOIN (SELECT DISTINCT person_id, film_id FROM film_crew) o ON o.person_id = c.person_id
        JOIN movies m ON m.film_id = o.film_id JOIN (SELECT DISTINCT tconst FROM spine) s ON s.tconst = m.imdb_id
        WHERE o.film_id <> center_id AND vote_count >= 200)"""
_LINK_VIEWS = "films_raw basics film_crew people movies"
_LINK_COLUMNS = "center_id, person_id, person_name, role, film_id, title, year, vote_average"


@query(f"""WITH {_LINKS} SELECT {_LINK_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY center_id, person_id
    ORDER BY vote_average DESC, film_id) AS rn FROM links) WHERE rn <= 5""", _LINK_VIEWS)
def crew_connections(t: Tables):
    return connections(t)


@query(f"""WITH {_LINKS} SELECT DISTINCT center_id, person_id, role, '/' || person_id || '.jpg' AS profile_path FROM links""", _LINK_VIEWS)
def crew_connection_profiles(t: Tables):
    """The bridging people of each film with their pictures, as the page shows them."""
    people = t.people.withColumn("profile_path", F.concat(F.lit("/"), F.col("person_id").cast("string"), F.lit(".jpg")))
    shown = V.crew_connections(t.film_crew, people, t.movies, bridge(t), about_people=("profile_path",))
    return shown.select("center_id", "person_id", "role", "profile_path").distinct()


@query(f"""WITH {_LINKS}, capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY center_id ORDER BY person_id, vote_average DESC, film_id) AS n FROM links) WHERE n <= 150)
    SELECT {_LINK_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY center_id, person_id ORDER BY vote_average DESC, film_id) AS rn FROM capped) WHERE rn <= 5""",
       _LINK_VIEWS)
def crew_connections_capped(t: Tables):
    """The page's form: at most 150 rows per film in person order, then five per person."""
    return connections(t, row_limit=150)


@query(f"""WITH {_LINKS} SELECT center_id, person_id, role, string_agg(film_id::string, ',' ORDER BY rn) AS films FROM (
    SELECT *, row_number() OVER (PARTITION BY center_id, person_id ORDER BY vote_average DESC, film_id) AS rn FROM links) WHERE rn <= 5 GROUP BY ALL""", _LINK_VIEWS)
def crew_connections_nested(t: Tables):
    """One row per bridging person with the connected films as a nested list."""
    flat = connections(t).withColumn("worse", -F.col("vote_average"))
    nested = V.nested_by(flat, ["center_id", "person_id", "role"], ["title"], "list", ["worse", "film_id"])
    return nested.select(
        "center_id", "person_id", "role", F.array_join(F.transform("list", lambda f: f["film_id"].cast("string")), ",").alias("films")
    )


@query(f"""WITH {FILMS}, k AS (SELECT DISTINCT s.film_id, source_wikidata_id, source_label, title, year FROM based_on JOIN spine s ON tconst = imdb_id)
    SELECT center_id, source_wikidata_id, source_label, film_id, title, year, cast(rn AS int) AS position FROM (
        SELECT a.film_id AS center_id, a.source_wikidata_id, a.source_label, b.film_id, b.title, b.year,
               row_number() OVER (PARTITION BY a.film_id ORDER BY a.source_label, b.year, b.film_id, a.source_wikidata_id) AS rn
        FROM k a JOIN k b ON a.source_wikidata_id = b.source_wikidata_id AND a.film_id <> b.film_id) WHERE rn <= 60""", "films_raw basics based_on")
def co_adaptations(t: Tables):
    return adaptations(t)


def adaptations(t: Tables):
    return V.co_adaptations(t.based_on, films(t))
