"""Film spine, relations, the unified table and people resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import resolve as R
from ..session import cut_lineage
from .quality_queries import _validated_akas, _validated_ratings, raw_ties
from .registry import Tables, query


def films(t: Tables):
    """Matched films: latest snapshots joined to the second source."""
    return R.film_spine(t.films_raw, t.basics, F.lit("2024-02-01").cast("timestamp"), raw_ties())


# Matched films and what hangs off them, as SQL for the checks.
FILMS = """spine AS (
    SELECT r.id AS film_id, r.imdb_id AS tconst, r.title, cast(year(cast(r.release_date AS date)) AS int) AS year, r.original_title, r.original_language,
           r.overview, r.runtime AS tmdb_runtime, r.budget, r.revenue, r.popularity, r.vote_average, r.vote_count,
           b."primaryTitle" AS imdb_title, cast(b."startYear" AS int) AS imdb_year, cast(b."runtimeMinutes" AS int) AS imdb_runtime, b.genres AS imdb_genres
    FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY load_ts DESC, delivery, source, vote_count, popularity, vote_average, revenue) AS rn
          FROM films_raw) r JOIN basics b ON b.tconst = r.imdb_id WHERE rn = 1 AND r.imdb_id <> '')"""
RATED = """valid_ratings AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY tconst, snapshot_date
            ORDER BY cast("numVotes" AS int) DESC, cast("averageRating" AS int) DESC) AS rn FROM ratings)
        WHERE rn = 1 AND cast("averageRating" AS double) BETWEEN 1.0 AND 10.0),
    rated AS (SELECT s.film_id, tconst, cast("averageRating" AS double) AS imdb_rating, cast("numVotes" AS bigint) AS imdb_votes, snapshot_date AS rating_snapshot_date
        FROM (SELECT tconst, "averageRating", "numVotes", snapshot_date,
                     row_number() OVER (PARTITION BY tconst ORDER BY snapshot_date DESC) AS rn2 FROM valid_ratings) v
        JOIN spine s USING (tconst) WHERE rn2 = 1)"""
VALID_AKAS = """valid_akas AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "titleId", ordering ORDER BY load_ts DESC, title, language,
        region NULLS LAST, types NULLS LAST) AS rn FROM akas) WHERE rn = 1)"""

_SPINE_COLUMNS = """film_id AS id, tconst, title, year, original_title, original_language, overview, tmdb_runtime, budget, revenue,
    popularity, vote_average, vote_count, imdb_title, imdb_year, imdb_runtime, imdb_genres"""


@query(f"WITH {FILMS} SELECT {_SPINE_COLUMNS}, film_id AS tmdb_id FROM spine", "films_raw basics")
def spine_merge(t: Tables):
    return films(t).drop("merged_ts")


@query(f"WITH {FILMS} SELECT DISTINCT tconst, film_id FROM spine", "films_raw basics")
def bridge_distinct(t: Tables):
    return bridge(t)


def bridge(t: Tables):
    return R.key_bridge(films(t))


@query(f"WITH {FILMS}, {RATED} SELECT * FROM rated", "films_raw basics ratings")
def rating_latest(t: Tables):
    return R.latest_ratings(_validated_ratings(t), bridge(t))


@query("""SELECT DISTINCT movement_wikidata_id, movement_label FROM movements
    UNION ALL SELECT DISTINCT festival_wikidata_id, festival_label FROM festivals""", "movements festivals")
def relation_dim(t: Tables):
    movements = R.relation_dim(t.movements, "movement_wikidata_id", "movement_label")
    return movements.union(R.relation_dim(t.festivals, "festival_wikidata_id", "festival_label"))


@query(f"""WITH {FILMS}
    SELECT DISTINCT film_id, tconst, movement_wikidata_id AS rel_id, movement_label AS label FROM movements JOIN spine ON tconst = imdb_id
    UNION ALL SELECT DISTINCT film_id, tconst, festival_wikidata_id, festival_label FROM festivals JOIN spine ON tconst = imdb_id
    UNION ALL SELECT DISTINCT film_id, tconst, source_wikidata_id, source_label FROM based_on JOIN spine ON tconst = imdb_id
    UNION ALL SELECT DISTINCT film_id, tconst, influence_wikidata_id, influence_label FROM influences JOIN spine ON tconst = imdb_id""",
       "films_raw basics movements festivals based_on influences")
def relation_bridge(t: Tables):
    out = None
    for df in relations(t, cut_lineage(bridge(t))).values():
        part = df.toDF("film_id", "tconst", "rel_id", "label")
        out = part if out is None else out.unionByName(part)
    return out


def relations(t: Tables, keys):
    """Bridges of the four relations."""
    return {
        "movements": R.relation_bridge(t.movements, keys, "movement_wikidata_id", "movement_label"),
        "festivals": R.relation_bridge(t.festivals, keys, "festival_wikidata_id", "festival_label"),
        "based_on": R.relation_bridge(t.based_on, keys, "source_wikidata_id", "source_label"),
        "influences": R.relation_bridge(t.influences, keys, "influence_wikidata_id", "influence_label"),
    }


@query(f"""WITH {FILMS} SELECT DISTINCT film_id, p.tconst, nconst, category AS crew_role, job, cast(ordering AS int) AS ordering
    FROM principals p JOIN spine s ON s.tconst = p.tconst
    WHERE category IN ('cinematographer', 'editor', 'composer', 'production_designer', 'costume_designer')""", "films_raw basics principals")
def crew_scoped(t: Tables):
    return R.crew_of_films(t.principals, bridge(t))


@query(f"""WITH {FILMS} SELECT nconst, "primaryName" AS name, cast("birthYear" AS int) AS birth_year, cast("deathYear" AS int) AS death_year,
        "primaryProfession" AS primary_profession FROM names WHERE nconst IN (
        SELECT nconst FROM principals p JOIN spine s ON s.tconst = p.tconst
        WHERE category IN ('cinematographer', 'editor', 'composer', 'production_designer', 'costume_designer'))""",
       "films_raw basics principals names")
def people_scoped(t: Tables):
    return R.people_of_crew(t.names, R.crew_of_films(t.principals, bridge(t)))


@query(f"""WITH {FILMS}, {VALID_AKAS} SELECT DISTINCT film_id, tconst, a.title AS aka_title, region, language, types AS title_type,
        "isOriginalTitle" = '1' AS is_original_title, cast(ordering AS int) AS ordering
    FROM valid_akas a JOIN spine ON tconst = "titleId" """, "films_raw basics akas")
def akas_scoped(t: Tables):
    return R.akas_of_films(_validated_akas(t), bridge(t))


def unified(t: Tables, spine=None):
    spine = cut_lineage(films(t)) if spine is None else spine  # used by every join below
    keys = R.key_bridge(spine)
    rel = relations(t, keys)
    ratings = R.latest_ratings(_validated_ratings(t), keys)
    stamp = F.lit("2024-02-01").cast("timestamp")
    return R.unify(spine, ratings, t.wikidata_ids, rel["festivals"], rel["movements"], rel["based_on"], rel["influences"], stamp)


UNIFIED = f"""{FILMS}, {RATED}, unified AS (
    SELECT s.*, w.wikidata_id, r.imdb_rating, r.imdb_votes, r.rating_snapshot_date, f.festivals, m.movements, b.based_on, i.influences
    FROM spine s LEFT JOIN rated r USING (film_id)
    LEFT JOIN (SELECT imdb_id, min(wikidata_id) AS wikidata_id FROM wikidata_ids GROUP BY imdb_id) w ON w.imdb_id = s.tconst
    LEFT JOIN (SELECT imdb_id, string_agg(DISTINCT festival_label, '|' ORDER BY festival_label) AS festivals FROM festivals GROUP BY 1) f ON f.imdb_id = s.tconst
    LEFT JOIN (SELECT imdb_id, string_agg(DISTINCT movement_label, '|' ORDER BY movement_label) AS movements FROM movements GROUP BY 1) m ON m.imdb_id = s.tconst
    LEFT JOIN (SELECT imdb_id, string_agg(DISTINCT source_label, '|' ORDER BY source_label) AS based_on FROM based_on GROUP BY 1) b ON b.imdb_id = s.tconst
    LEFT JOIN (SELECT imdb_id, string_agg(DISTINCT influence_label, '|' ORDER BY influence_label) AS influences FROM influences GROUP BY 1) i ON i.imdb_id = s.tconst)"""
UNIFIED_VIEWS = "films_raw basics ratings wikidata_ids festivals movements based_on influences"


@query(f"""WITH {UNIFIED} SELECT film_id, tconst, wikidata_id, title, original_title, original_language, year, overview, tmdb_runtime, budget,
    revenue, popularity, vote_average AS tmdb_rating, vote_count AS tmdb_votes, imdb_title, imdb_year, imdb_runtime, imdb_genres, imdb_rating, imdb_votes,
    rating_snapshot_date, festivals, movements, based_on, influences FROM unified""", UNIFIED_VIEWS)
def unified_wide(t: Tables):
    wide = unified(t).drop("merged_ts", "unified_at")
    arrays = ["festivals", "movements", "based_on", "influences"]
    return wide.withColumns({c: F.array_join(c, "|") for c in arrays})


@query(f"""WITH {UNIFIED}, {VALID_AKAS},
    crew AS (SELECT film_id, count(*) AS crew_count FROM (SELECT DISTINCT s.film_id, nconst, category, job, ordering FROM principals p JOIN spine s ON s.tconst = p.tconst
        WHERE category IN ('cinematographer', 'editor', 'composer', 'production_designer', 'costume_designer')) GROUP BY film_id),
    aka AS (SELECT film_id, count(*) AS aka_count FROM (SELECT DISTINCT film_id, a.title, region, language, types, ordering, "isOriginalTitle"
        FROM valid_akas a JOIN spine ON tconst = "titleId") GROUP BY film_id)
    SELECT film_id, coalesce(title, imdb_title) AS display_title, coalesce(tmdb_runtime, imdb_runtime) AS runtime, coalesce(year, imdb_year) AS release_year,
           coalesce(crew_count, 0) AS crew_count, coalesce(aka_count, 0) AS aka_count, imdb_rating IS NOT NULL AS has_rating,
           wikidata_id IS NOT NULL AS has_wikidata, festivals IS NOT NULL AS has_festivals, movements IS NOT NULL AS has_movements,
           based_on IS NOT NULL AS has_based_on, influences IS NOT NULL AS has_influences, crew_count IS NOT NULL AS has_crew, aka_count IS NOT NULL AS has_akas
    FROM unified LEFT JOIN crew USING (film_id) LEFT JOIN aka USING (film_id)""", UNIFIED_VIEWS + " principals akas")
def unified_flags(t: Tables):
    spine = cut_lineage(films(t))
    keys = R.key_bridge(spine)
    rich = R.enrich(unified(t, spine), R.crew_of_films(t.principals, keys), R.akas_of_films(_validated_akas(t), keys))
    flags = [c for c in rich.columns if c.startswith("has_")]
    return rich.select("film_id", "display_title", "runtime", "release_year", "crew_count", "aka_count", *flags)


@query(f"""WITH {UNIFIED} SELECT count(*) AS total, count(wikidata_id) AS wikidata, count(imdb_rating) AS rating, count(based_on) AS source,
    round(count(wikidata_id) * 100.0::double / count(*), 4) AS wikidata_pct, round(count(imdb_rating) * 100.0::double / count(*), 4) AS rating_pct,
    round(count(based_on) * 100.0::double / count(*), 4) AS source_pct FROM unified""", UNIFIED_VIEWS)
def unified_coverage(t: Tables):
    from ..operators.quality import coverage

    has = {"wikidata": F.col("wikidata_id").isNotNull(), "rating": F.col("imdb_rating").isNotNull(), "source": F.size("based_on") > 0}
    return coverage(unified(t), has)


# ---- people --------------------------------------------------------------------------------


@query("""SELECT person_id AS tmdb_person_id, name AS tmdb_name, imdb_id AS nconst, 'imdb_id_direct' AS method, 1.0::double AS confidence
    FROM er_people WHERE imdb_id <> ''""", "er_people")
def er_direct(t: Tables):
    return R.direct_links(t.er_people)


def _sides(t: Tables):
    keys = t.er_bridge
    return R.unresolved_credits(t.er_people, t.er_crew, keys), R.named_principals(t.er_principals, t.er_names, keys)


_NORMAL = r"""list_aggregate(list_sort(string_split(trim(lower(regexp_replace(strip_accents({0}), '[^a-zA-Z0-9]+', ' ', 'g'))), ' ')), 'string_agg', ' ')"""
_CANDIDATES = f"""a AS (SELECT DISTINCT b.tconst, {_NORMAL.format('name')} AS name_a FROM er_crew c JOIN er_bridge b USING (film_id)
        JOIN er_people p USING (person_id) WHERE p.imdb_id IS NULL OR p.imdb_id = ''),
    b AS (SELECT DISTINCT q.tconst, {_NORMAL.format('"primaryName"')} AS name_b FROM er_principals q JOIN er_bridge USING (tconst) JOIN er_names USING (nconst)),
    cand AS (SELECT a.tconst, name_a, name_b FROM a JOIN b USING (tconst)
        WHERE levenshtein(name_a, name_b) <= floor(0.1 * (length(name_a) + length(name_b)) + 1e-9))"""


@query(f"WITH {_CANDIDATES} SELECT tconst, name_a, name_b FROM cand", "er_people er_crew er_bridge er_principals er_names")
def er_candidates(t: Tables):
    return R.candidate_names(*_sides(t))


@query(f"WITH {_CANDIDATES} SELECT tconst, name_a, name_b FROM cand", "er_people er_crew er_bridge er_principals er_names")
def er_candidates_hot_blocks(t: Tables):
    """The same pairs when films with more than a few names count as too crowded to pair them."""
    return R.candidate_names(*_sides(t), block_pairs=12)


# The score needs the longest common subsequence, here one bit per letter of the first name
# (names of up to 100 letters): each letter of the second name updates all bits at once.
_LCS = """length(name_a) - bit_count(list_reduce(
        list_prepend(full_row, list_transform(string_split(name_b, ''), lambda c: list_sum(list_transform(range(1, length(name_a) + 1),
            lambda i: CASE WHEN name_a[i] = c THEN 1::hugeint << (i - 1)::int ELSE 0::hugeint END))::hugeint)),
        lambda s, m: ((s + (s & m)) | (s - (s & m))) & full_row))"""
_SCORED = f"""{_CANDIDATES},
    pairs AS (SELECT DISTINCT name_a, name_b, (1::hugeint << length(name_a)::int) - 1 AS full_row FROM cand),
    scores AS (SELECT name_a, name_b, (1.0::double - (length(name_a) + length(name_b) - 2 * ({_LCS}))::double / (length(name_a) + length(name_b))) * 100.0::double AS score FROM pairs),
    credited AS (SELECT DISTINCT b.tconst, person_id, {_NORMAL.format('name')} AS name_a FROM er_crew JOIN er_bridge b USING (film_id) JOIN er_people p USING (person_id)
        WHERE p.imdb_id IS NULL OR p.imdb_id = ''),
    billed AS (SELECT DISTINCT q.tconst, nconst, {_NORMAL.format('"primaryName"')} AS name_b FROM er_principals q JOIN er_bridge USING (tconst) JOIN er_names USING (nconst)),
    linked AS (SELECT person_id AS tmdb_person_id, nconst, score FROM (
        SELECT person_id, nconst, score, row_number() OVER (PARTITION BY person_id ORDER BY score DESC, nconst) AS rn
        FROM credited JOIN billed USING (tconst) JOIN scores USING (name_a, name_b) WHERE score >= 90) WHERE rn = 1)"""
_ER_VIEWS = "er_people er_crew er_bridge er_principals er_names"
_RESOLVED = f"""{_SCORED},
    both_passes AS (SELECT person_id AS tmdb_person_id, imdb_id AS nconst, 'imdb_id_direct' AS method, 1.0::double AS confidence FROM er_people WHERE imdb_id <> ''
        UNION ALL SELECT tmdb_person_id, nconst, 'film_anchored', score / 100.0::double FROM linked),
    settled AS (SELECT tmdb_person_id, nconst, method, confidence FROM (
        SELECT *, row_number() OVER (PARTITION BY nconst ORDER BY confidence DESC, tmdb_person_id) AS rn FROM both_passes) WHERE rn = 1),
    everyone AS (SELECT * FROM settled
        UNION ALL SELECT DISTINCT person_id, NULL, 'tmdb_only', NULL FROM (SELECT * FROM er_crew UNION ALL SELECT * FROM er_cast) JOIN er_bridge USING (film_id)
            WHERE person_id NOT IN (SELECT tmdb_person_id FROM settled)
        UNION ALL SELECT DISTINCT NULL, nconst, 'imdb_only', NULL FROM er_principals JOIN er_bridge USING (tconst) WHERE nconst NOT IN (SELECT nconst FROM settled)),
    resolved AS (SELECT *, CASE WHEN method IN ('imdb_id_direct', 'film_anchored') THEN 'both' ELSE method END AS source FROM everyone)"""


@query(f"""WITH pairs AS (SELECT nconst, {_NORMAL.format('name')} AS name_a, {_NORMAL.format('"primaryName"')} AS name_b
        FROM er_people JOIN er_names ON nconst = 'nm' || person_id),
    masked AS (SELECT *, (1::hugeint << length(name_a)::int) - 1 AS full_row FROM pairs)
    SELECT nconst, round((1.0::double - (length(name_a) + length(name_b) - 2 * ({_LCS}))::double / (length(name_a) + length(name_b))) * 100.0::double, 6) AS score FROM masked""",
       "er_people er_names")
def token_sort(t: Tables):
    """Similarity of every person's two spellings."""
    ours = t.er_people.select(F.concat(F.lit("nm"), F.col("person_id").cast("string")).alias("nconst"), "name")
    both = ours.join(t.er_names, "nconst")
    score = N.token_sort_ratio(N.normalise_name("name"), N.normalise_name("primaryName"))
    return both.select("nconst", F.round(score, 6).alias("score"))


@query(f"WITH {_SCORED} SELECT tmdb_person_id, nconst, round(score, 6) AS score FROM linked", _ER_VIEWS)
def er_scored(t: Tables):
    return R.fuzzy_links(*_sides(t)).withColumn("score", F.round("score", 6))


def resolved_people(t: Tables):
    settled = R.settle_conflicts(R.direct_links(t.er_people), R.fuzzy_links(*_sides(t)))
    return R.complete_scope(settled, t.er_crew, t.er_cast, t.er_principals, t.er_bridge)


@query(f"WITH {_RESOLVED} SELECT tmdb_person_id, nconst, method, round(confidence, 6) AS confidence, source FROM resolved", _ER_VIEWS + " er_cast")
def er_resolved(t: Tables):
    return resolved_people(t).withColumn("confidence", F.round("confidence", 6))


@query(f"WITH {_RESOLVED} SELECT method, source, count(*) AS n FROM resolved GROUP BY ALL", _ER_VIEWS + " er_cast")
def er_breakdown(t: Tables):
    from ..operators.quality import value_distribution

    return value_distribution(resolved_people(t), ["method", "source"])


@query(f"""WITH {_RESOLVED} SELECT tmdb_person_id, p.name AS tmdb_name, r.nconst, n."primaryName" AS imdb_name, round(confidence, 6) AS confidence
    FROM (SELECT * FROM resolved WHERE method = 'film_anchored' ORDER BY confidence, tmdb_person_id LIMIT 20) r
    JOIN er_people p ON p.person_id = tmdb_person_id JOIN er_names n ON n.nconst = r.nconst""", _ER_VIEWS + " er_cast")
def er_review_queue(t: Tables):
    return R.review_queue(resolved_people(t), t.er_people, t.er_names).withColumn("confidence", F.round("confidence", 6))
