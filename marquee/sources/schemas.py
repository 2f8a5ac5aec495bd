"""Schemas of the landed documents and tables; reads never infer them."""

from __future__ import annotations

# Field names and types of the sources' records.
FILMS = """
    id bigint, imdb_id string, title string, original_title string, original_language string,
    status string, release_date string, runtime bigint, budget bigint, revenue bigint,
    popularity double, vote_average double, vote_count bigint, adult boolean, video boolean,
    homepage string, tagline string, overview string, belongs_to_collection string,
    poster_path string, backdrop_path string,
    genres array<struct<id:bigint,name:string>>,
    production_companies array<struct<id:bigint,logo_path:string,name:string,origin_country:string>>,
    production_countries array<struct<iso_3166_1:string,name:string>>,
    spoken_languages array<struct<english_name:string,iso_639_1:string,name:string>>
"""
PEOPLE = """
    id bigint, imdb_id string, name string, gender bigint, birthday string, deathday string,
    known_for_department string, place_of_birth string, popularity double, biography string,
    profile_path string, also_known_as array<string>
"""
CREDITS = """
    id bigint,
    cast array<struct<credit_id:string,id:bigint,character:string,order:bigint,cast_id:bigint>>,
    crew array<struct<credit_id:string,id:bigint,department:string,job:string>>
"""
RELEASES = """
    id bigint,
    countries array<struct<iso_3166_1:string,certification:string,release_date:string,
        primary:boolean,descriptors:array<string>>>
"""
REVIEWS = """
    id bigint,
    results array<struct<id:string,author:string,author_details:struct<username:string,rating:double>,
        content:string,created_at:string,updated_at:string,url:string>>
"""
BASICS = "tconst string, titleType string, primaryTitle string, startYear string, runtimeMinutes string, genres string"
RATINGS = "tconst string, averageRating string, numVotes string"
AKAS = """
    titleId string, ordering string, title string, region string, language string, types string,
    attributes string, isOriginalTitle string
"""
PRINCIPALS = "tconst string, ordering string, nconst string, category string, job string, characters string"
NAMES = """
    nconst string, primaryName string, birthYear string, deathYear string, primaryProfession string
"""
SPARQL_RESULT = "results struct<bindings:array<map<string,struct<value:string>>>>"

LINEAGE = ["source_system", "source_endpoint", "source_file", "load_ts"]
