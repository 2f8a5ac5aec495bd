"""The first source's nested documents, made from the given tables, and what each flattener takes out of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import typed_null
from ..operators import flatten as X
from ..operators import gold as G
from ..sources import schemas
from . import build
from .registry import Tables, query


def _fitted(df: DataFrame, schema: str) -> DataFrame:
    """The document columns in their landed types; those not given are null."""
    wanted = T.StructType.fromDDL(schema)
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted))


def film_documents(t: Tables) -> DataFrame:
    brand, kind, key = F.col("p_brand"), F.col("p_type"), F.col("p_partkey").cast("string")
    words = F.split("p_name", " ")
    empty = F.lit("")
    docs = t.part.select(
        F.col("p_partkey").alias("id"),
        F.when(F.col("p_size") > 40, empty).otherwise(F.concat(F.lit("tt"), key)).alias("imdb_id"),
        F.col("p_name").alias("title"),
        F.lower(kind).alias("original_language"),
        F.concat((F.col("p_size") + 1975).cast("string"), F.lit("-06-15T00:00:00.000Z")).alias("release_date"),
        F.col("p_size").alias("runtime"),
        F.floor("p_retailprice").alias("budget"),
        (F.col("p_retailprice") / 10).alias("popularity"),
        (F.col("p_size") % 2 == 0).alias("adult"),
        F.when(F.col("p_size") > 20, brand).otherwise(F.lit("  ")).alias("homepage"),
        F.when(F.col("p_size") <= 10, F.concat(F.lit('{"id": '), F.col("p_size").cast("string"), F.lit(', "name": "'), brand, F.lit('"}'))).alias("belongs_to_collection"),
        F.transform(words, lambda w: F.struct(F.length(w).alias("id"), F.concat(F.lit("length "), F.length(w).cast("string")).alias("name"))).alias("genres"),
        F.array(
            F.struct(F.length(brand).alias("id"), F.lit("/logo").alias("logo_path"), F.concat(F.lit("company "), F.length(brand).cast("string")).alias("name"), empty.alias("origin_country")),
            F.struct(F.lit(0).alias("id"), F.lit(None).cast("string").alias("logo_path"), F.lit("house").alias("name"), F.lit("FR").alias("origin_country")),
        ).alias("production_companies"),
        F.array(F.struct(brand.alias("iso_3166_1"), F.lower(brand).alias("name")), F.struct(brand.alias("iso_3166_1"), F.lower(brand).alias("name"))).alias("production_countries"),
        F.transform(words, lambda w: F.struct(F.upper(w).alias("english_name"), w.alias("iso_639_1"), F.initcap(w).alias("name"))).alias("spoken_languages"),
    )
    return _fitted(docs, schemas.FILMS)


def people_documents(t: Tables) -> DataFrame:
    rich = F.col("s_acctbal") > 0
    docs = t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.when(rich, F.concat(F.lit("nm"), F.col("s_suppkey").cast("string"))).otherwise(F.lit(" ")).alias("imdb_id"),
        F.col("s_name").alias("name"),
        (F.col("s_nationkey") % 3).alias("gender"),
        F.when(rich, F.concat((F.col("s_nationkey") + 1940).cast("string"), F.lit("-01-31"))).otherwise(F.lit("unknown")).alias("birthday"),
        F.when(F.col("s_nationkey") > 12, F.concat(F.lit(" place "), F.col("s_nationkey").cast("string"))).otherwise(F.lit("")).alias("place_of_birth"),
        F.col("s_acctbal").alias("popularity"),
    )
    return _fitted(docs, schemas.PEOPLE)


def credit_documents(t: Tables) -> DataFrame:
    """One document per order and supplier with the lines of both as cast or crew; an order repeats none of them often."""
    name = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    cast = F.struct(name.alias("credit_id"), F.col("l_partkey").alias("id"), F.concat(F.lit("Role "), F.col("l_linenumber").cast("string")).alias("character"), F.col("l_linenumber").cast("bigint").alias("order"), typed_null("bigint").alias("cast_id"))
    crew = F.struct(name.alias("credit_id"), F.col("l_partkey").alias("id"), F.lit("D").alias("department"), F.concat(F.lit("Job "), F.col("l_linenumber").cast("string")).alias("job"))
    even = F.col("l_linenumber") % 2 == 0
    nested = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.collect_list(F.when(even, cast)).alias("cast"), F.collect_list(F.when(~even, crew)).alias("crew"))
    return _fitted(nested.select(F.col("l_orderkey").alias("id"), "cast", "crew"), schemas.CREDITS)


def release_documents(t: Tables) -> DataFrame:
    day = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00.000Z"))
    item = F.struct(
        F.col("l_suppkey").cast("string").alias("iso_3166_1"),
        F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag")).alias("certification"),
        F.when(F.col("l_linestatus") == "O", day).alias("release_date"),
        (F.col("l_linestatus") == "O").alias("primary"),
        F.array().cast("array<string>").alias("descriptors"),
    )
    nested = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.collect_set(item).alias("countries"))
    return _fitted(nested.select(F.col("l_partkey").alias("id"), "countries"), schemas.RELEASES)


def review_documents(t: Tables) -> DataFrame:
    turn = F.col("turn").cast("string")
    item = F.struct(
        F.concat_ws("-", F.col("conv_id").cast("string"), turn).alias("id"),
        F.col("role").alias("author"),
        F.struct(F.upper("role").alias("username"), F.col("turn").cast("double").alias("rating")).alias("author_details"),
        F.col("text").alias("content"),
        F.concat(F.lit("2020-01-0"), (F.col("turn") % 9 + 1).cast("string"), F.lit("T10:00:00.000Z")).alias("created_at"),
        F.when(F.col("turn") % 2 == 0, F.lit("bad")).alias("updated_at"),
        typed_null("string").alias("url"),
    )
    # A document is one page of ten turns.
    nested = t.conversations.groupBy("conv_id", F.floor(F.col("turn") / 10).alias("page")).agg(F.collect_list(item).alias("results"))
    return _fitted(nested.select(F.col("conv_id").alias("id"), "results"), schemas.REVIEWS)


def _as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


@query("""SELECT p_partkey AS film_id, CASE WHEN p_size <= 40 THEN 'tt' || p_partkey END AS imdb_id, p_name AS title, CAST(NULL AS string) AS original_title,
    lower(p_type) AS original_language, CAST(NULL AS string) AS status, (1975 + p_size) || '-06-15' AS release_date, p_size::int AS runtime, floor(p_retailprice)::bigint AS budget,
    CAST(NULL AS bigint) AS revenue, p_retailprice / 10 AS popularity, CAST(NULL AS double) AS vote_average, CAST(NULL AS int) AS vote_count, p_size % 2 = 0 AS adult,
    CAST(NULL AS boolean) AS video, CASE WHEN p_size > 20 THEN p_brand END AS homepage, CAST(NULL AS string) AS tagline, CAST(NULL AS string) AS overview,
    CASE WHEN p_size <= 10 THEN p_size END::bigint AS collection_id, CASE WHEN p_size <= 10 THEN p_brand END AS collection_name,
    CAST(NULL AS string) AS poster_path, CAST(NULL AS string) AS backdrop_path FROM part""")
def flatten_films(t: Tables):
    return _as_text(X.films(film_documents(t)), "release_date")


@query("""SELECT s_suppkey AS person_id, CASE WHEN s_acctbal > 0 THEN 'nm' || s_suppkey END AS imdb_id, s_name AS name, (s_nationkey % 3)::int AS gender,
    CASE WHEN s_acctbal > 0 THEN (1940 + s_nationkey) || '-01-31' END AS birthday, CAST(NULL AS string) AS deathday, CAST(NULL AS string) AS known_for_department,
    CASE WHEN s_nationkey > 12 THEN ' place ' || s_nationkey END AS place_of_birth, s_acctbal AS popularity, CAST(NULL AS string) AS biography, CAST(NULL AS string) AS profile_path FROM supplier""")
def flatten_people(t: Tables):
    return _as_text(X.people(people_documents(t)), "birthday", "deathday")


_CREDIT_ID = "l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber"


@query(f"""SELECT DISTINCT {_CREDIT_ID} AS credit_id, l_orderkey AS film_id, l_partkey AS person_id, 'Role ' || l_linenumber AS character, l_linenumber AS cast_order,
    CAST(NULL AS int) AS cast_id FROM lineitem WHERE l_linenumber % 2 = 0""")
def flatten_cast(t: Tables):
    return X.film_cast(credit_documents(t))


@query(f"""SELECT DISTINCT {_CREDIT_ID} AS credit_id, l_orderkey AS film_id, l_partkey AS person_id, 'D' AS department, 'Job ' || l_linenumber AS job
    FROM lineitem WHERE l_linenumber % 2 = 1""")
def flatten_crew(t: Tables):
    return X.film_crew(credit_documents(t))


@query("""SELECT DISTINCT length(p_brand) AS company_id, 'company ' || length(p_brand) AS company_name, CAST(NULL AS string) AS origin_country, '/logo' AS logo_path FROM part
    UNION ALL SELECT DISTINCT 0, 'house', 'FR', NULL FROM part""")
def flatten_companies(t: Tables):
    return X.companies(film_documents(t))[0]


@query("SELECT p_partkey AS film_id, unnest([0, length(p_brand)]) AS company_id FROM part")
def flatten_film_companies(t: Tables):
    return X.companies(film_documents(t))[1]


@query("""SELECT DISTINCT w AS language_iso, upper(w[1]) || w[2:] AS language_name, upper(w) AS english_name FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part)""")
def flatten_languages(t: Tables):
    return X.languages(film_documents(t))[0]


@query("SELECT DISTINCT p_partkey AS film_id, unnest(string_split(p_name, ' ')) AS language_iso FROM part")
def flatten_film_languages(t: Tables):
    return X.languages(film_documents(t))[1]


@query("SELECT p_partkey AS film_id, p_brand AS country_iso FROM part")
def flatten_film_countries(t: Tables):
    return X.film_countries(film_documents(t))


@query("""SELECT country_iso, max(country_name) AS country_name FROM (SELECT p_brand AS country_iso, lower(p_brand) AS country_name FROM part
    UNION ALL SELECT l_suppkey::string, NULL FROM lineitem) GROUP BY country_iso""")
def flatten_countries(t: Tables):
    return X.countries(film_documents(t), release_documents(t))


_RELEASES = """releases AS (SELECT DISTINCT l_partkey AS film_id, l_suppkey::string AS country_iso, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS certification,
    CASE WHEN l_linestatus = 'O' THEN cast(l_shipdate AS date) END AS release_date, l_linestatus = 'O' AS is_primary FROM lineitem)"""


@query(f"""WITH {_RELEASES} SELECT film_id, country_iso, certification, release_date::string AS release_date, is_primary, CAST(NULL AS int) AS release_type, 0 AS descriptors FROM releases""")
def flatten_releases(t: Tables):
    found = X.film_releases(release_documents(t))
    return _as_text(found, "release_date").withColumn("descriptors", F.size("descriptors"))


@query("""SELECT conv_id || '-' || turn AS review_id, conv_id AS film_id, role AS author, upper(role) AS author_username, turn::double AS author_rating, text AS content,
    epoch_us(TIMESTAMP '2020-01-01 10:00:00') + (turn % 9) * 86400000000 AS created_us, CAST(NULL AS bigint) AS updated_us, CAST(NULL AS string) AS url FROM conversations""")
def flatten_reviews(t: Tables):
    found = X.film_reviews(review_documents(t))
    micros = {f"{c}_us": F.unix_micros(F.col(f"{c}_at").cast("timestamp")) for c in ("created", "updated")}
    return found.withColumns(micros).drop("created_at", "updated_at")


# ---- the star's release part -------------------------------------------------------------


@query("""SELECT company_id AS company_key_of, company_name, origin_country FROM (
    SELECT DISTINCT length(p_brand) AS company_id, 'company ' || length(p_brand) AS company_name, CAST(NULL AS string) AS origin_country FROM part
    UNION ALL SELECT DISTINCT 0, 'house', 'FR' FROM part)""")
def star_dim_company(t: Tables):
    """Company dimension; the surrogate key must be one to one with the company."""
    companies = X.companies(film_documents(t))[0]
    dim = G.dim_plain(companies, "company_id", "company_key")
    told = dim.join(companies.select(G.surrogate_key("company_id").alias("company_key"), F.col("company_id").alias("company_key_of")), "company_key")
    return told.select("company_key_of", "company_name", "origin_country")


@query("""SELECT country_iso AS country_key_of, max(country_name) AS country_name FROM (SELECT p_brand AS country_iso, lower(p_brand) AS country_name FROM part
    UNION ALL SELECT l_suppkey::string, NULL FROM lineitem) GROUP BY country_iso""")
def star_dim_country(t: Tables):
    countries = X.countries(film_documents(t), release_documents(t))
    dim = G.dim_plain(countries, "country_iso", "country_key")
    told = dim.join(countries.select(G.surrogate_key("country_iso").alias("country_key"), F.col("country_iso").alias("country_key_of")), "country_key")
    return told.select("country_key_of", "country_name")


@query(f"""WITH {_RELEASES} SELECT p_name AS title, country_iso, (year(release_date) * 10000 + month(release_date) * 100 + day(release_date))::int AS date_key, certification, is_primary,
    count(*) AS n FROM releases JOIN part ON p_partkey = film_id GROUP BY ALL""")
def star_fact_release(t: Tables):
    """The release fact, read back through the surrogate keys of its film and country dimensions."""
    fact = G.fact_release(X.film_releases(release_documents(t)))
    films = X.films(film_documents(t)).select(G.surrogate_key("film_id").alias("film_key"), "title")
    countries = X.countries(film_documents(t), release_documents(t)).select(G.surrogate_key("country_iso").alias("country_key"), "country_iso")
    told = fact.join(films, "film_key").join(countries, "country_key")
    return told.groupBy("title", "country_iso", F.col("date_key").cast("int").alias("date_key"), "certification", "is_primary").agg(F.count("*").alias("n"))


@query("""SELECT 'people' AS table_name, 'people' AS source_endpoint, count(*) AS n, 'catalog' AS source_system, true AS loaded FROM supplier
    UNION ALL SELECT 'movies', 'movies', count(*), 'catalog', true FROM part
    UNION ALL SELECT 'film_production_countries', 'movies', count(*), 'catalog', true FROM part
    UNION ALL SELECT 'film_reviews', 'reviews', count(*), 'catalog', true FROM conversations""")
def silver_tables_stamped(t: Tables):
    """Flattened tables carry where each row came from and when it was loaded."""
    documents = {"movies": film_documents(t), "people": people_documents(t), "credits": credit_documents(t), "releases": release_documents(t), "reviews": review_documents(t)}
    tables = build.flatten_documents(documents)
    parts = [
        tables[n].groupBy("source_system", "source_endpoint", F.col("loaded_at").isNotNull().alias("loaded")).agg(F.count("*").alias("n")).withColumn("table_name", F.lit(n))
        for n in ("people", "movies", "film_production_countries", "film_reviews")
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
