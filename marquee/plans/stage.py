"""The catalogue's tables as views over the given test tables.

Each view is one SELECT in the SQL subset that Spark and DuckDB share, so a query and its
check read the same inputs. ``{name}`` is a given table; EACH_WORD and ELEMENT are the two
spots where the dialects differ.
"""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import table

_RELEASED = "cast(cast(1975 + p_size AS string) || '-06-15' AS date)"
_TITLE_KEY = "'tt' || cast({0} AS string)"
_PART_KEY = _TITLE_KEY.format("p_partkey")
_LINE_KEY = _TITLE_KEY.format("l_partkey")
_JOB = """CASE
        WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Director'
        WHEN l_returnflag = 'A' THEN 'Director of Photography'
        WHEN l_linestatus = 'F' AND l_linenumber <= 3 THEN 'Writer'
        WHEN l_linestatus = 'F' THEN 'Original Music Composer'
        WHEN l_linenumber <= 3 THEN 'Producer'
        ELSE 'Editor' END"""

VIEWS = {
    # -- first source: films, people and what joins them
    "movies": f"""
        SELECT p_partkey AS film_id, {_PART_KEY} AS imdb_id, p_name AS title, upper(p_name) AS original_title,
               {_RELEASED} AS release_date, CASE WHEN p_size > 10 THEN 60 + 2 * p_size END AS runtime,
               CASE WHEN p_size >= 45 THEN cast(0 AS bigint) ELSE cast(floor(p_retailprice * p_size) AS bigint) END AS budget,
               CASE WHEN p_size <= 5 THEN cast(0 AS bigint) ELSE a.revenue END AS revenue,
               cast(p_size AS double) AS popularity, a.vote_average, a.vote_count, '/' || p_brand || '.jpg' AS poster_path
        FROM {{part}} LEFT JOIN (
            SELECT l_partkey, cast(sum(cast(floor(l_extendedprice) AS bigint)) AS bigint) AS revenue,
                   avg(round(l_discount * 100)) AS vote_average, cast(sum(l_quantity) AS int) AS vote_count
            FROM {{lineitem}} GROUP BY l_partkey) a ON l_partkey = p_partkey""",
    "films_raw": f"""
        SELECT l_partkey AS id, CASE WHEN p_size = 50 THEN '' ELSE {_LINE_KEY} END AS imdb_id, p_name AS title,
               upper(p_name) AS original_title, lower(p_type) AS original_language, p_brand AS overview,
               cast({_RELEASED} AS string) AS release_date, 60 + 2 * p_size AS runtime,
               cast(floor(p_retailprice) AS bigint) AS budget, cast(floor(l_extendedprice) AS bigint) AS revenue,
               l_quantity AS popularity, round(l_discount * 100) AS vote_average, l_linenumber AS vote_count,
               l_shipdate AS load_ts, l_orderkey AS delivery, l_suppkey AS source
        FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey""",
    "people": """
        SELECT s_suppkey AS person_id, CASE WHEN s_acctbal > 0 THEN 'nm' || cast(s_suppkey AS string) END AS imdb_id,
               s_name AS name FROM {supplier}""",
    "film_genres": "SELECT DISTINCT p_partkey AS film_id, EACH_WORD(p_name) AS genre_id FROM {part}",
    "genres": "SELECT genre_id, upper(genre_id) AS genre_name FROM (SELECT DISTINCT EACH_WORD(p_name) AS genre_id FROM {part}) w",
    "film_crew": f"""
        SELECT DISTINCT l_partkey AS film_id, l_suppkey AS person_id, {_JOB} AS job
        FROM {{lineitem}} WHERE l_returnflag <> 'N'""",
    "film_cast": """
        SELECT DISTINCT l_partkey AS film_id, l_suppkey AS person_id, l_linenumber AS cast_order,
               'Role ' || l_linestatus AS character FROM {lineitem} WHERE l_returnflag = 'N'""",
    "film_reviews": """
        SELECT conv_id AS film_id, cast(conv_id AS string) || '-' || cast(turn AS string) AS review_id, role AS author,
               cast(turn AS double) AS author_rating, text AS content, turn AS created_at FROM {conversations}""",
    "trends": """
        SELECT user_id AS film_id, ts AS snapshot_ts, value AS popularity, event_type AS status,
               cast(floor(value) AS bigint) AS revenue, cast(floor(value * 2) AS int) AS vote_count FROM {events}""",
    # -- second source
    "basics": f"""
        SELECT {_PART_KEY} AS tconst, lower(p_name) AS "primaryTitle", cast(1975 + p_size AS string) AS "startYear",
               CASE WHEN p_size > 3 THEN cast(61 + 2 * p_size AS string) END AS "runtimeMinutes",
               replace(p_name, ' ', ',') AS genres FROM {{part}} WHERE p_type <> 'PROMO'""",
    "ratings": f"""
        SELECT {_LINE_KEY} AS tconst, cast(cast(l_shipdate AS date) AS string) AS snapshot_date,
               cast(cast(round(l_discount * 100) AS int) AS string) AS "averageRating",
               cast(cast(l_quantity AS int) AS string) AS "numVotes" FROM {{lineitem}}""",
    "principals": f"""
        SELECT DISTINCT {_LINE_KEY} AS tconst, cast(l_linenumber AS string) AS ordering,
               'nm' || cast(l_suppkey AS string) AS nconst,
               CASE l_linenumber WHEN 1 THEN 'cinematographer' WHEN 2 THEN 'editor' WHEN 3 THEN 'composer'
                    WHEN 4 THEN 'production_designer' WHEN 5 THEN 'costume_designer' ELSE 'actor' END AS category,
               CASE WHEN l_linestatus = 'O' THEN 'lead' END AS job FROM {{lineitem}}""",
    "names": """
        SELECT 'nm' || cast(s_suppkey AS string) AS nconst, s_name AS "primaryName",
               cast(1930 + s_nationkey AS string) AS "birthYear", CASE WHEN s_acctbal < 0 THEN '2001' END AS "deathYear",
               'producer,' || lower(s_name) AS "primaryProfession" FROM {supplier}""",
    "akas": f"""
        SELECT {_LINE_KEY} AS "titleId", cast(l_linenumber AS string) AS ordering,
               'Title ' || cast(l_suppkey AS string) AS title, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS region,
               l_linestatus AS language, CASE WHEN l_quantity > 25 THEN 'alternative' END AS types,
               CASE WHEN l_linenumber = 1 THEN '1' ELSE '0' END AS "isOriginalTitle", l_shipdate AS load_ts
        FROM {{lineitem}}""",
    # -- third source
    "wikidata_ids": f"""
        SELECT 'Q' || cast(p_partkey AS string) AS wikidata_id, {_PART_KEY} AS imdb_id FROM {{part}} WHERE p_size <= 40
        UNION ALL
        SELECT 'Q0' || cast(p_partkey AS string), {_PART_KEY} FROM {{part}} WHERE p_size <= 3""",
    "based_on": f"""
        SELECT {_PART_KEY} AS imdb_id, p_brand AS source_wikidata_id, lower(p_brand) AS source_label
        FROM {{part}} WHERE p_size <= 30""",
    "movements": f"""
        SELECT {_PART_KEY} AS imdb_id, p_type AS movement_wikidata_id, lower(p_type) AS movement_label
        FROM {{part}} WHERE p_size > 10""",
    "festivals": f"""
        SELECT {_LINE_KEY} AS imdb_id, 'F' || cast(l_linenumber AS string) AS festival_wikidata_id,
               'Festival ' || cast(l_linenumber AS string) AS festival_label FROM {{lineitem}} WHERE l_linestatus = 'O'""",
    "influences": f"""
        SELECT {_PART_KEY} AS imdb_id, split_part(p_name, ' ', 1) AS influence_wikidata_id,
               split_part(p_name, ' ', 2) AS influence_label FROM {{part}} WHERE p_size > 20""",
    # -- embedding space
    "film_xy": """
        SELECT vec_id AS film_id, cast(ELEMENT(embedding, 0) AS double) AS x, cast(ELEMENT(embedding, 1) AS double) AS y,
               label AS theme FROM {embeddings}""",
    # -- people of both sources on sparsely credited films
    "er_people": """
        SELECT p_partkey AS person_id, p_name || ' ' || lower(p_brand) || ' ' || p_type AS name,
               CASE WHEN p_size <= 20 THEN 'nm' || cast(p_partkey AS string) WHEN p_size <= 22 THEN '' END AS imdb_id
        FROM {part}""",
    "er_names": """
        SELECT 'nm' || cast(p_partkey AS string) AS nconst,
               p_type || ', ' || CASE WHEN p_size > 35 THEN replace(replace(p_name, 't', 'tt'), 'g', 'gh')
                                      WHEN p_size > 30 THEN replace(p_name, 'e', 'é') ELSE p_name END || ' ' || p_brand AS "primaryName"
        FROM {part}""",
    "er_crew": "SELECT DISTINCT l_orderkey AS film_id, l_partkey AS person_id FROM {lineitem} WHERE l_linestatus = 'F'",
    "er_cast": "SELECT DISTINCT l_orderkey AS film_id, l_partkey AS person_id FROM {lineitem} WHERE l_linestatus = 'O'",
    "er_bridge": """
        SELECT 'tt' || cast(o_orderkey AS string) AS tconst, o_orderkey AS film_id FROM {orders} WHERE o_orderstatus <> 'P'""",
    "er_principals": """
        SELECT DISTINCT 'tt' || cast(l_orderkey AS string) AS tconst, 'nm' || cast(l_partkey AS string) AS nconst FROM {lineitem}""",
    # -- a sparse film-person graph for paths, hubs and recommendations
    "credits": "SELECT DISTINCT l_orderkey AS film_id, l_partkey AS person_id FROM {lineitem}",
}


def _inputs(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(text) if name})


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text = VIEWS[name]
    text = re.sub(r"EACH_WORD\((\w+)\)", r"explode(split(\1, ' '))", text)
    text = re.sub(r"ELEMENT\((\w+), (\d+)\)", r"\1[\2]", text)
    text = re.sub(r'"(\w+)"', r"`\1`", text)
    return spark.sql(text, **{t: table(spark, folder, t) for t in _inputs(text)})


def view_sql(name: str) -> str:
    text = VIEWS[name]
    text = re.sub(r"EACH_WORD\((\w+)\)", r"unnest(string_split(\1, ' '))", text)
    text = re.sub(r"ELEMENT\((\w+), (\d+)\)", lambda m: f"{m[1]}[{int(m[2]) + 1}]", text)
    return text.format(**{t: t for t in _inputs(text)})


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views as common table expressions; a body that opens
    with WITH continues the list."""
    ctes = ",\n".join(f"{n} AS ({view_sql(n)})" for n in names.split())
    body = body.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
