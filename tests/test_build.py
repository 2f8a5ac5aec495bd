"""Landed files to marts on a small hand-made delivery."""

import datetime as dt
import gzip
import json

from pyspark.sql import functions as F

from marquee.plans import build as B
from marquee.sources import readers, writers

LOAD = dt.datetime(2024, 1, 1)


def film(i, **kw):
    base = {
        "id": i, "imdb_id": f"tt{i}", "title": f"Film {i}", "release_date": "2010-05-01", "runtime": 100, "budget": 10, "revenue": 50,
        "popularity": 1.5, "vote_average": 7.0, "vote_count": 900, "homepage": " ", "belongs_to_collection": '{"id": 4, "name": "Saga"}',
        "genres": [{"id": 1, "name": "Drama"}, {"id": 1, "name": "Drama"}], "production_companies": [{"id": 8, "name": "Co", "origin_country": ""}],
        "production_countries": [{"iso_3166_1": "FR", "name": "France"}], "spoken_languages": [{"iso_639_1": "fr", "name": "Français"}], "surplus": 1,
    }
    return {**base, **kw}


def write_json(folder, name, docs, extra=""):
    (folder / name).mkdir(parents=True)
    for i, chunk in enumerate((docs[:1], docs[1:])):
        (folder / name / f"{i}.json").write_text("".join(json.dumps(d) + "\n" for d in chunk) + extra)


def write_tsv(folder, name, header, lines):
    folder.joinpath(name).mkdir(parents=True)
    with gzip.open(folder / name / "part.tsv.gz", "wt") as f:
        f.write("\n".join(["\t".join(header), *["\t".join(x) for x in lines]]) + "\n")


def documents(folder):
    write_json(folder, "movies", [film(1), film(2, title=None), film(3, imdb_id=""), {"title": "no id"}], extra='{"id": 9, "ti')
    write_json(folder, "people", [
        {"id": 10, "imdb_id": "nm10", "name": "Ann Direct", "also_known_as": ["A. D.", " ", "A. D."]},
        {"id": 11, "imdb_id": None, "name": "Éric Long-Name"}, {"id": 12, "name": "Only Here", "also_known_as": []},
        {"id": 13, "name": "Namesake Ten Ann Direct"},
    ])
    crew = lambda pid, job: {"credit_id": f"c{pid}{job}", "id": pid, "department": "D", "job": job}
    write_json(folder, "credits", [
        {"id": 1, "cast": [{"credit_id": "x1", "id": 12, "character": "Her", "order": 0}], "crew": [crew(10, "Director"), crew(11, "Editor"), crew(11, "Editor")]},
        {"id": 2, "cast": None, "crew": [crew(10, "Producer")]},
    ])
    release = {"iso_3166_1": "US", "certification": "", "release_date": "2010-05-01T00:00:00.000Z", "primary": True, "descriptors": ["a"]}
    write_json(folder, "releases", [{"id": 1, "countries": [release, release, {**release, "certification": "R"}]}, {"id": 2, "countries": []}])
    review = {"id": "r1", "author": "z", "author_details": {"username": "zz", "rating": 8.0}, "content": "good", "created_at": "2020-01-01T10:00:00.000Z", "updated_at": "bad"}
    write_json(folder, "reviews", [{"id": 1, "results": [review, review]}, {"id": 2, "results": None}])


def dumps(folder):
    write_tsv(folder, "basics", ["tconst", "titleType", "primaryTitle", "startYear", "runtimeMinutes", "genres"], [
        ["tt1", "movie", '"Quoted start', "2010", "\\N", "Drama"], ["tt2", "movie", "Second \\ Film", "2011", "95", "\\N"],
        ["tt7", "short", "Short", "2011", "5", "\\N"], ["tt8", "movie", "Old", "1700", "5", "\\N"]])
    write_tsv(folder, "ratings", ["tconst", "averageRating", "numVotes"], [["tt1", "8.0", "600"], ["tt2", "0.5", "9"], ["tt7", "9.0", "5"]])
    write_tsv(folder, "akas", ["titleId", "ordering", "title", "region", "language", "types", "attributes", "isOriginalTitle"], [
        ["tt1", "1", "Un film", "FR", "fr", "\\N", "\\N", "0"], ["tt1", "2", "Film 1", "US", "en", "\\N", "\\N", "1"]])
    write_tsv(folder, "principals", ["tconst", "ordering", "nconst", "category", "job", "characters"], [
        ["tt1", "1", "nm11", "editor", "\\N", "\\N"], ["tt1", "2", "nm50", "composer", "\\N", "\\N"], ["tt1", "3", "nm60", "actor", "\\N", "[]"]])
    write_tsv(folder, "names", ["nconst", "primaryName", "birthYear", "deathYear", "primaryProfession"], [
        ["nm11", "Long Name, Eric", "1950", "\\N", "editor"], ["nm50", "Someone Else", "\\N", "\\N", "composer"], ["nm60", "Actor", "\\N", "\\N", "actor"]])


def relations(spark):
    ts = F.lit(LOAD)
    frame = lambda rows, *cols: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).withColumn("load_ts", ts)
    return {
        "imdb_ids": frame([("Q1", "tt1", "2010"), ("Q0", "tt1", "2010"), (None, "tt2", "2010")], "wikidata_id", "imdb_id", "year"),
        "movements": frame([("Q1", "tt1", "M1", "noir"), ("Q1", "tt1", "M1", "noir")], "wikidata_id", "imdb_id", "movement_wikidata_id", "movement_label"),
        "festivals": frame([("Q1", "tt1", "F1", "Cannes"), ("Q1", "tt1", "F2", "Berlin"), ("Q1", "tt1", "F1", "Cannes")], "wikidata_id", "imdb_id", "festival_wikidata_id", "festival_label"),
        "based_on": frame([("Q1", "tt1", "S1", "Novel")], "wikidata_id", "imdb_id", "source_wikidata_id", "source_label"),
        "influenced_by": frame([("Q1", "tt1", None, "nobody")], "wikidata_id", "imdb_id", "influence_wikidata_id", "influence_label"),
    }


def test_end_to_end(spark, tmp_path):
    def stored(tables, layer):
        B.save(tables, str(tmp_path / layer))
        return B.load(spark, str(tmp_path / layer), tables)

    documents(tmp_path / "docs")
    dumps(tmp_path / "dumps")
    bronze = stored(B.land_documents(spark, str(tmp_path / "docs"), F.lit(LOAD)), "bronze")
    assert bronze["movies"].count() == 4  # the cut-off line is skipped
    valid, bad = B.validate_documents(bronze, "2024-01-01")
    valid = stored(valid, "valid")
    assert valid["movies"].count() == 3 and [r.fail_reason for r in bad["movies"].collect()] == ["null_id"]
    silver = stored(B.merge_silver({}, B.flatten_documents(valid)), "silver")
    counts = {n: df.count() for n, df in silver.items()}
    assert counts == {
        "movies": 3, "people": 4, "person_aliases": 1, "film_cast": 1, "film_crew": 3, "genres": 1, "film_genres": 3, "production_companies": 1,
        "film_production_companies": 3, "film_production_countries": 3, "languages": 1, "film_spoken_languages": 3, "countries": 2,
        "film_releases": 2, "film_reviews": 1,
    }
    one = silver["movies"].filter("film_id = 1").first()
    assert (one.homepage, one.collection_id, one.collection_name, str(one.release_date)) == (None, 4, "Saga", "2010-05-01")
    review = silver["film_reviews"].first()
    assert review.author_username == "zz" and review.created_at == dt.datetime(2020, 1, 1, 10) and review.updated_at is None
    assert {r.country_name for r in silver["countries"].collect()} == {"France", None}
    assert silver["production_companies"].first().origin_country is None

    second_raw = stored(B.land_dumps(spark, str(tmp_path / "dumps"), "2024-01-01", F.lit(LOAD)), "dumped")
    second, second_bad = B.validate_dumps(second_raw, "2024-01-01")
    assert {r.tconst: r.primaryTitle for r in second["basics"].collect()} == {"tt1": '"Quoted start', "tt2": "Second \\ Film"}
    assert second_bad["ratings"].first().fail_reason == "bad_rating" and second["ratings"].count() == 1
    second = stored(second, "second")
    third, third_bad = B.validate_relations(relations(spark), "2024-01-01")
    assert third["festivals"].count() == 2 and third_bad["influenced_by"].count() == 1 and third_bad["imdb_ids"].count() == 1

    catalog = stored(B.unify_sources(valid["movies"], second, stored(third, "third"), silver), "catalog")
    people = {(r.tmdb_person_id, r.nconst): (r.method, r.source) for r in catalog["people_resolved"].collect()}
    assert people == {
        (10, "nm10"): ("imdb_id_direct", "both"), (11, "nm11"): ("film_anchored", "both"),
        (12, None): ("tmdb_only", "tmdb_only"), (None, "nm50"): ("imdb_only", "imdb_only"),
    }
    wide = {r.film_id: r for r in catalog["unified_enriched"].collect()}
    assert set(wide) == {1, 2}
    assert wide[1].wikidata_id == "Q0" and wide[1].festivals == ["Berlin", "Cannes"] and wide[2].festivals is None
    assert wide[1].runtime == 100 and wide[2].display_title == "Second \\ Film" and not wide[2].has_rating and wide[1].crew_count == 2
    assert wide[1].influences is None and not wide[1].has_influences and wide[1].has_akas
    marts = B.marts(catalog["unified_silver"], silver)
    board = {r.film_id: (r.combined_rating, r.profit) for r in marts["film_leaderboard"].collect()}
    assert board == {1: (7.5, 40), 2: (7.0, 40)}
    assert marts["director_leaderboard"].first().film_count == 1

    # A second delivery: one film changes, one is new; history keeps both states.
    later = tmp_path / "later"
    write_json(later, "movies", [film(1, title="Film one", vote_count=950), film(4)])
    for name in ("people", "credits", "releases", "reviews"):
        write_json(later, name, [])
    batch = B.land_documents(spark, str(later), F.lit(LOAD + dt.timedelta(days=1)))
    bronze = B.extend_bronze(bronze, batch)
    history = B.metric_history(bronze["movies"].filter("id is not null"))
    assert history.count() == 5 and history.filter("is_current").count() == 4
    merged = B.merge_silver(silver, B.flatten_documents(B.validate_documents(bronze, "2024-01-02")[0]))
    assert {r.film_id: r.title for r in merged["movies"].collect()} == {1: "Film one", 2: None, 3: "Film 3", 4: "Film 4"}
    B.save({"movies": merged["movies"]}, str(tmp_path / "run2"))
    assert B.load(spark, str(tmp_path / "run2"), ["movies"])["movies"].count() == 4
    stamps = {n: {(r.source_system, r.source_endpoint) for r in df.select("source_system", "source_endpoint").distinct().collect()} for n, df in silver.items()}
    assert stamps["film_crew"] == {("catalog", "credits")} and stamps["genres"] == {("catalog", "movies")}
    assert all("loaded_at" in df.columns and df.filter("loaded_at is null").isEmpty() for df in silver.values())


def test_relations_are_replaced_unless_empty(spark):
    first = B.merge_relations({}, relations(spark))
    empty = {n: df.limit(0) for n, df in first.items()}
    again = B.merge_relations(first, empty)
    assert {n: df.count() for n, df in again.items()} == {n: df.count() for n, df in first.items()}


def test_tsv_edge_cases(spark, tmp_path):
    write_tsv(tmp_path, "t", ["a", "b"], [["1", '"open'], ["2", "\\N"], ["3", 'mid "q" x'], ["4", ""]])
    got = {r.a: r.b for r in readers.tsv(spark, str(tmp_path / "t"), "a string, b string").collect()}
    assert got == {"1": '"open', "2": None, "3": 'mid "q" x', "4": ""}


def test_quarantine_grows_columns(spark, tmp_path):
    v, q = str(tmp_path / "v"), str(tmp_path / "q")
    a = spark.createDataFrame([(1, "x")], "id int, fail_reason string")
    b = spark.createDataFrame([(2, "y", 5)], "id int, fail_reason string, extra int")
    assert writers.write_split(a, a, v, q) == (1, 1) and writers.write_split(b, b, v, q) == (1, 1)
    assert spark.read.parquet(v).count() == 1
    assert sorted(map(tuple, writers.read_evolved(spark, q).select("id", "extra").collect())) == [(1, None), (2, 5)]


def test_many_small_keys_are_written_by_several_tasks(spark):
    rows = spark.range(900).select((F.col("id") % 450).alias("key"), "id")
    dealt = writers.dealt_by_files(rows, "key").select("key", F.spark_partition_id().alias("part")).distinct().collect()
    assert len(dealt) == 450 and len({r.part for r in dealt}) == 5
    assert writers.dealt_by_files(rows.limit(0), "key").count() == 0
    assert writers.dealt_by_files(rows.select(F.lit(None).cast("long").alias("key"), "id"), "key").count() == 900
