"""The whole build, from landed files to the unified table and the marts.

Every function takes and returns tables by name; ``save`` writes a run's tables to a
folder of its own and ``load`` reads one back, so a run never overwrites what it reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import flatten as X
from ..operators import gold as G
from ..operators import incremental as I
from ..operators import quality as Q
from ..operators import resolve as R
from ..session import cut_lineage
from ..sources import lineage, readers, schemas

DOCUMENTS = {
    "movies": schemas.FILMS,
    "people": schemas.PEOPLE,
    "credits": schemas.CREDITS,
    "releases": schemas.RELEASES,
    "reviews": schemas.REVIEWS,
}
DUMPS = {
    "basics": schemas.BASICS,
    "ratings": schemas.RATINGS,
    "akas": schemas.AKAS,
    "principals": schemas.PRINCIPALS,
    "names": schemas.NAMES,
}
# Key parts that must be present in the third source's relation tables.
RELATIONS = {
    "imdb_ids": ("wikidata_id", "imdb_id"),
    "movements": ("wikidata_id", "movement_wikidata_id"),
    "festivals": ("wikidata_id", "festival_wikidata_id"),
    "based_on": ("wikidata_id", "source_wikidata_id"),
    "influenced_by": ("wikidata_id", "influence_wikidata_id"),
}
MERGE_KEYS = {
    "movies": ["film_id"],
    "people": ["person_id"],
    "person_aliases": ["person_id", "alias"],
    "film_cast": ["credit_id"],
    "film_crew": ["credit_id"],
    "genres": ["genre_id"],
    "film_genres": ["film_id", "genre_id"],
    "production_companies": ["company_id"],
    "film_production_companies": ["film_id", "company_id"],
    "film_production_countries": ["film_id", "country_iso"],
    "languages": ["language_iso"],
    "film_spoken_languages": ["film_id", "language_iso"],
    "countries": ["country_iso"],
    "film_releases": X.RELEASE_KEY,
    "film_reviews": ["review_id"],
}
NULL_SAFE = {"film_releases": ["release_date", "certification"]}

Tables = dict[str, DataFrame]


def land_documents(spark: SparkSession, folder: str, load_ts: Column | None = None) -> Tables:
    """First-source batch: enforced schemas, malformed lines skipped, lineage stamped."""
    out = {}
    for name, schema in DOCUMENTS.items():
        df = readers.json_tolerant(spark, f"{folder}/{name}", schema)
        out[name] = lineage.stamp_bronze(df, "tmdb", name, F.col("source_file"), load_ts)
    return out


def land_dumps(spark: SparkSession, folder: str, snapshot_date: str, load_ts: Column | None = None) -> Tables:
    """Second-source batch: films only, the credits and names that belong to them."""
    read = lambda name, **kw: readers.tsv(spark, f"{folder}/{name}", DUMPS[name], **kw)
    # Gzipped dumps can't be split: what several tables need is read from them once.
    basics = cut_lineage(read("basics", keep=F.col("titleType") == "movie"))
    titles = basics.select("tconst")
    principals = I.restrict_to(read("principals", drop=["characters"]), titles, "tconst")
    crew = cut_lineage(principals.filter(F.col("category").isin(Q.CREW_CATEGORIES)))
    out = {
        "basics": basics,
        "ratings": I.restrict_to(read("ratings"), titles, "tconst").withColumn("snapshot_date", F.lit(snapshot_date)),
        "akas": I.restrict_to(read("akas", drop=["attributes"]), titles.withColumnRenamed("tconst", "titleId"), "titleId"),
        "principals": crew,
        "names": read("names").join(crew.select("nconst").distinct(), "nconst", "left_semi"),
    }
    return {n: lineage.stamp_bronze(df, "imdb", n, f"{n}.tsv", load_ts) for n, df in out.items()}


def extend_bronze(bronze: Tables, batch: Tables, keys: dict[str, list[str]] | None = None) -> Tables:
    """Raw tables are append-only. With ``keys`` only unseen keys of those tables are added."""
    out = dict(bronze)
    for name, df in batch.items():
        if name not in bronze:
            out[name] = df
            continue
        fresh = lineage.align_to(df, bronze[name].schema)
        if keys and name in keys:
            fresh = I.new_keys(fresh, bronze[name], keys[name])
        out[name] = bronze[name].unionByName(fresh)
    return out


def validate_documents(bronze: Tables, run_date: str) -> tuple[Tables, Tables]:
    rules = [Q.Rule("null_id", F.col("id").isNotNull())]
    sides = {n: Q.dedup_then_split(bronze[n], ["id"], rules, run_date) for n in DOCUMENTS if n in bronze}
    return {n: s.valid for n, s in sides.items()}, {n: s.quarantine for n, s in sides.items()}


def validate_dumps(bronze: Tables, run_date: str) -> tuple[Tables, Tables]:
    rules = {
        "basics": Q.basics_rules(),
        "ratings": Q.ratings_rules(),
        "akas": Q.akas_rules(),
        "principals": Q.principals_rules(),
        "names": Q.names_rules(),
    }
    sides = {n: Q.dedup_then_split(bronze[n], Q.DEDUP_KEYS[n], r, run_date) for n, r in rules.items() if n in bronze}
    return {n: s.valid for n, s in sides.items()}, {n: s.quarantine for n, s in sides.items()}


def validate_relations(bronze: Tables, run_date: str) -> tuple[Tables, Tables]:
    """Rows whose composite key has a missing part are quarantined, never collapsed."""
    valid, bad = {}, {}
    for name, keys in RELATIONS.items():
        if name in bronze:
            rules = [Q.Rule("null_" + "_or_".join(keys), F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())]
            side = Q.dedup_then_split(bronze[name], list(keys), rules, run_date)
            valid[name], bad[name] = side.valid, side.quarantine
    return valid, bad


#: The kind of document each flattened table comes from; the others come from film documents.
ORIGIN = {
    "people": "people", "person_aliases": "people", "film_cast": "credits", "film_crew": "credits",
    "film_releases": "releases", "film_reviews": "reviews",
}


def flatten_documents(valid: Tables, system: str = "catalog", loaded_at: Column | None = None) -> Tables:
    """Every table of the first source, each row stamped with where it came from and when it was loaded."""
    tables = _flattened(valid)
    return {n: lineage.stamp_silver(df, system, ORIGIN.get(n, "movies"), loaded_at) for n, df in tables.items()}


def _flattened(valid: Tables) -> Tables:
    films, people, credits = valid["movies"], valid["people"], valid["credits"]
    genres, film_genres = X.genres(films)
    companies, film_companies = X.companies(films)
    languages, film_languages = X.languages(films)
    person = F.col("id").alias("person_id")
    return {
        "movies": X.films(films),
        "people": X.people(people),
        "person_aliases": X.aliases(people, person, "also_known_as", "person_id"),
        "film_cast": X.film_cast(credits),
        "film_crew": X.film_crew(credits),
        "genres": genres,
        "film_genres": film_genres,
        "production_companies": companies,
        "film_production_companies": film_companies,
        "film_production_countries": X.film_countries(films),
        "languages": languages,
        "film_spoken_languages": film_languages,
        "countries": X.countries(films, valid["releases"]),
        "film_releases": X.film_releases(valid["releases"]),
        "film_reviews": X.film_reviews(valid["reviews"]),
    }


def merge_silver(silver: Tables, fresh: Tables) -> Tables:
    """Upserts every flattened table by its own key; a first run simply takes the rows."""
    return {
        n: I.merge_scd1(silver[n], df, MERGE_KEYS[n], NULL_SAFE.get(n, [])) if n in silver else df for n, df in fresh.items()
    }


def metric_history(films_bronze: DataFrame) -> DataFrame:
    return I.scd2_history(X.metric_snapshots(films_bronze), "film_id", "snapshot_ts")


def merge_relations(tables: Tables, fresh: Tables) -> Tables:
    """Links and adaptations are upserted; movements, festivals and influences are replaced
    as a whole, unless the delivery is empty."""
    out = dict(tables)
    for name, df in fresh.items():
        if name in ("imdb_ids", "based_on") and name in tables:
            out[name] = I.merge_scd1(tables[name], df, list(RELATIONS[name]), order_by="load_ts")
        elif name not in tables or not df.isEmpty():
            out[name] = df
    return out


def unify_sources(films_valid: DataFrame, second: Tables, third: Tables, silver: Tables) -> Tables:
    """Spine, bridges, resolved people and the unified table."""
    films = cut_lineage(R.film_spine(films_valid, second["basics"]))  # every bridge below starts from it
    bridge = R.key_bridge(films)
    relate = lambda name, key, label: R.relation_bridge(third[name], bridge, key, label)
    out = {
        "films": films,
        "matched_tconsts": bridge,
        "imdb_film_ratings": R.latest_ratings(second["ratings"], bridge),
        "imdb_film_crew": R.crew_of_films(second["principals"], bridge),
        "imdb_film_akas": R.akas_of_films(second["akas"], bridge),
        "wikidata_movements": R.relation_dim(third["movements"], "movement_wikidata_id", "movement_label"),
        "wikidata_festivals": R.relation_dim(third["festivals"], "festival_wikidata_id", "festival_label"),
        "wikidata_film_movements": relate("movements", "movement_wikidata_id", "movement_label"),
        "wikidata_film_festivals": relate("festivals", "festival_wikidata_id", "festival_label"),
        "wikidata_film_based_on": relate("based_on", "source_wikidata_id", "source_label"),
        "wikidata_film_influences": relate("influenced_by", "influence_wikidata_id", "influence_label"),
    }
    out["imdb_people"] = R.people_of_crew(second["names"], out["imdb_film_crew"])
    credits = R.unresolved_credits(silver["people"], silver["film_crew"], bridge)
    named = R.named_principals(second["principals"], second["names"], bridge)
    settled = R.settle_conflicts(R.direct_links(silver["people"]), R.fuzzy_links(credits, named))
    out["people_resolved"] = R.complete_scope(settled, silver["film_crew"], silver["film_cast"], second["principals"], bridge)
    unified = R.unify(
        films, out["imdb_film_ratings"], third["imdb_ids"], out["wikidata_film_festivals"], out["wikidata_film_movements"],
        out["wikidata_film_based_on"], out["wikidata_film_influences"],
    )
    out["unified_silver"] = unified
    out["unified_enriched"] = R.enrich(unified, out["imdb_film_crew"], out["imdb_film_akas"])
    return out


def marts(unified: DataFrame, silver: Tables) -> Tables:
    return {
        "film_leaderboard": G.film_leaderboard(unified),
        "genre_trends": G.genre_trends(unified, silver["film_genres"], silver["genres"]),
        "yearly_summary": G.yearly_summary(unified),
        "director_leaderboard": G.director_leaderboard(unified, silver["film_crew"], silver["people"]),
        "actor_leaderboard": G.actor_leaderboard(unified, silver["film_cast"], silver["people"]),
    }


def save(tables: Tables, folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")


def load(spark: SparkSession, folder: str, names) -> Tables:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}
