"""Deduplication, data quality, scalars, joins, aggregates and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import scalars as S
from ..operators import dedup as D
from ..operators import flatten as X
from ..operators import quality as Q
from ..operators import skew
from ..session import scratch_path
from ..sources import writers
from .registry import Tables, query

RUN_DATE = "2024-02-01"


# ---- latest and dedup ---------------------------------------------------------------


@query("""
    SELECT user_id, event_id, epoch_us(ts) AS ts_us, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def bronze_latest_per_key(t: Tables):
    latest = D.latest_per_key(t.events, ["user_id"], "ts", [F.col("event_id")])
    return latest.select("user_id", "event_id", micros("ts").alias("ts_us"), "event_type", "value")


def micros(c):
    """Microseconds since the epoch, a form both engines agree on."""
    return F.unix_micros(F.col(c).cast("timestamp"))


@query("""
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def bronze_latest_composite(t: Tables):
    latest = D.latest_per_key(t.events, ["user_id", "event_type"], "ts", [F.col("event_id")])
    return latest.select("user_id", "event_type", "event_id", "value")


@query("SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def bronze_dedup_unstamped(t: Tables):
    keys = ["l_orderkey", "l_linenumber"]
    once = D.latest_per_key(t.lineitem, keys, order_by="load_ts", ties=[F.col("l_partkey")])
    return once.select(*keys, "l_partkey")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


# ---- hard and soft checks -------------------------------------------------------------

_DIRTY = """dirty AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS id,
    CASE WHEN event_type <> 'signup' OR value > 40 THEN event_type END AS kind, event_id, ts, value FROM events)"""


def dirty_events(t: Tables):
    """Events with keys missing on errors and kinds missing on small signups."""
    return t.events.select(
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("id"),
        F.when((F.col("event_type") != "signup") | (F.col("value") > 40), F.col("event_type")).alias("kind"),
        "event_id", "ts", "value",
    )


def _split_events(t: Tables, **kw):
    rules = [Q.Rule("null_id", F.col("id").isNotNull()), Q.Rule("null_kind", F.col("kind").isNotNull())]
    return Q.dedup_then_split(dirty_events(t), ["id"], rules, RUN_DATE, order_by="ts", ties=[F.col("event_id")], **kw)


_LATEST_DIRTY = f"""WITH {_DIRTY}, latest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id) AS rn FROM dirty WHERE id IS NOT NULL)
    WHERE rn = 1)"""
_REASON = """concat_ws(',', CASE WHEN id IS NULL THEN 'null_id' END, CASE WHEN kind IS NULL THEN 'null_kind' END)"""


@query(f"{_LATEST_DIRTY} SELECT id, kind, event_id, value FROM latest WHERE kind IS NOT NULL")
def dq_split_valid(t: Tables):
    return _split_events(t).valid.select("id", "kind", "event_id", "value")


@query(f"""{_LATEST_DIRTY}
    SELECT event_id, value, {_REASON} AS fail_reason, '{RUN_DATE}' AS dq_run_date
    FROM (SELECT id, kind, event_id, value FROM latest WHERE kind IS NULL
          UNION ALL SELECT id, kind, event_id, value FROM dirty WHERE id IS NULL)""")
def dq_split_quarantine(t: Tables):
    return _split_events(t).quarantine.select("event_id", "value", "fail_reason", "dq_run_date")


@query(f"""WITH {_DIRTY}, latest AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, event_id) AS rn FROM dirty) WHERE rn = 1)
    SELECT event_id, {_REASON} AS fail_reason FROM latest WHERE id IS NULL OR kind IS NULL""")
def dq_split_collapsed(t: Tables):
    return _split_events(t, dedup_first=True).quarantine.select("event_id", "fail_reason")


@query(f"""WITH {_DIRTY} SELECT count(*) FILTER (WHERE id IS NOT NULL AND kind IS NOT NULL) AS valid,
    count(*) FILTER (WHERE id IS NULL OR kind IS NULL) AS quarantined FROM dirty""")
def dq_required_keys(t: Tables):
    sides = Q.split_required(dirty_events(t), ["id", "kind"], RUN_DATE)
    valid = sides.valid.select(F.lit(1).alias("v"), F.lit(0).alias("q"))
    bad = sides.quarantine.select(F.lit(0).alias("v"), F.lit(1).alias("q"))
    return valid.union(bad).agg(F.sum("v").alias("valid"), F.sum("q").alias("quarantined"))


@query("""
    SELECT tconst, snapshot_date, "averageRating", "numVotes" FROM r
    EXCEPT
    SELECT tconst, snapshot_date, "averageRating", "numVotes" FROM r
    WHERE regexp_matches(tconst, '^tt[0-9]+$') AND cast("averageRating" AS double) BETWEEN 1.0 AND 10.0
          AND cast("numVotes" AS bigint) >= 0""".replace(" r\n", " ratings\n"), "ratings")
def dq_except_quarantine(t: Tables):
    return Q.complement(t.ratings, Q.all_pass(Q.ratings_rules()))


@query("""
    SELECT tconst, snapshot_date, "averageRating", "numVotes" FROM (
        SELECT *, row_number() OVER (PARTITION BY tconst, snapshot_date
                                     ORDER BY cast("numVotes" AS int) DESC, cast("averageRating" AS int) DESC) AS rn FROM ratings)
    WHERE rn = 1 AND cast("averageRating" AS double) BETWEEN 1.0 AND 10.0""", "ratings")
def dq_ratings_validated(t: Tables):
    return _validated_ratings(t)


def _validated_ratings(t: Tables):
    ties = [F.col("numVotes").try_cast("int").desc(), F.col("averageRating").try_cast("int").desc()]
    return Q.split(D.latest_per_key(t.ratings, Q.DEDUP_KEYS["ratings"], ties=ties), Q.ratings_rules(), RUN_DATE).valid


@query("""
    SELECT category, count(*) AS n FROM principals
    WHERE category IN ('cinematographer', 'editor', 'composer', 'production_designer', 'costume_designer') GROUP BY category""",
       "principals")
def dq_principals_validated(t: Tables):
    valid = Q.split(t.principals, Q.principals_rules(), RUN_DATE).valid
    return Q.value_distribution(valid, ["category"])


@query("""
    SELECT tconst, "primaryTitle", "startYear" FROM basics
    WHERE "primaryTitle" IS NOT NULL AND cast("startYear" AS int) BETWEEN 1990 AND 2020""", "basics")
def dq_basics_validated(t: Tables):
    return Q.split(t.basics, Q.basics_rules(1990, 2020), RUN_DATE).valid.select("tconst", "primaryTitle", "startYear")


@query("""
    SELECT "titleId", ordering, title FROM (
        SELECT *, row_number() OVER (PARTITION BY "titleId", ordering ORDER BY load_ts DESC, title, language,
               region NULLS LAST, types NULLS LAST) AS rn FROM akas) WHERE rn = 1""", "akas")
def dq_akas_validated(t: Tables):
    return _validated_akas(t).select("titleId", "ordering", "title")


def _validated_akas(t: Tables):
    ties = [F.col("title"), F.col("language"), F.col("region").asc_nulls_last(), F.col("types").asc_nulls_last()]
    return Q.split(D.latest_per_key(t.akas, Q.DEDUP_KEYS["akas"], "load_ts", ties), Q.akas_rules(), RUN_DATE).valid


@query("""SELECT nconst, "primaryName" FROM names WHERE regexp_matches(nconst, '^nm[0-9]+$') AND "primaryName" IS NOT NULL""", "names")
def dq_names_validated(t: Tables):
    return Q.split(t.names, Q.names_rules(), RUN_DATE).valid.select("nconst", "primaryName")


@query("""
    SELECT count(*) FILTER (WHERE release_date IS NULL OR release_date < DATE '2000-01-01' OR release_date > DATE '2020-01-01') AS bad_release,
           count(*) FILTER (WHERE vote_average < 5 OR vote_average > 10) AS bad_vote, count(*) FILTER (WHERE runtime < 90) AS short_runtime,
           count(*) FILTER (WHERE title IS NULL) AS null_title FROM movies""", "movies")
def dq_soft_counts(t: Tables):
    checks = Q.film_soft_checks(today="2020-01-01")
    checks["bad_vote"] = (F.col("vote_average") < 5) | (F.col("vote_average") > 10)
    checks["short_runtime"] = F.col("runtime") < 90
    del checks["negative_runtime"]
    return Q.soft_counts(t.movies.withColumn("release_date", F.col("release_date").cast("string")), checks)


@query("""
    SELECT count(*) FILTER (WHERE release_date IS NULL OR release_date < DATE '2000-01-01' OR release_date > DATE '2020-01-01') AS bad_release,
           count(*) FILTER (WHERE vote_average < 0 OR vote_average > 10) AS bad_vote, count(*) FILTER (WHERE runtime < 0) AS negative_runtime,
           count(*) FILTER (WHERE title IS NULL) AS null_title FROM movies""", "movies")
def dq_soft_counts_shipped(t: Tables):
    """The film checks as they are shipped."""
    return Q.soft_counts(t.movies.withColumn("release_date", F.col("release_date").cast("string")), Q.film_soft_checks(today="2020-01-01"))


@query("SELECT count(*) FILTER (WHERE s_acctbal < 0) AS null_name FROM supplier")
def dq_people_soft_counts(t: Tables):
    people = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("name"))
    return Q.soft_counts(people, Q.people_soft_checks())


_RELATED = """rel AS (SELECT CASE WHEN p_size > 5 THEN p_partkey END AS wikidata_id, CASE WHEN p_size < 45 THEN p_brand END AS item, CASE WHEN p_size % 3 > 0 THEN lower(p_brand) END AS label FROM part)"""


@query(f"""WITH {_RELATED} SELECT kind, count(*) AS valid, count(*) FILTER (WHERE label IS NULL) AS null_label FROM rel, (SELECT unnest(['movement', 'festival', 'source', 'influence']) AS kind)
    WHERE wikidata_id IS NOT NULL AND item IS NOT NULL GROUP BY kind""")
def dq_label_soft_counts(t: Tables):
    """Labels missing among the valid rows of each of the four relations."""
    out = None
    for kind in ("movement", "festival", "source", "influence"):
        key, label = f"{kind}_wikidata_id", f"{kind}_label"
        rows = t.part.select(
            F.when(F.col("p_size") > 5, F.col("p_partkey")).alias("wikidata_id"), F.when(F.col("p_size") < 45, F.col("p_brand")).alias(key),
            F.when(F.col("p_size") % 3 > 0, F.lower("p_brand")).alias(label),
        )
        side = Q.split_required(rows, ["wikidata_id", key], RUN_DATE)
        found = Q.soft_counts(side.valid, Q.label_soft_checks(label)).select(
            F.lit(kind).alias("kind"), F.lit(side.validated).cast("long").alias("valid"), F.col(f"null_{label}").alias("null_label")
        )
        out = found if out is None else out.unionByName(found)
    return out


@query(f"""WITH {_DIRTY} SELECT event_id, id, kind, concat_ws(',', CASE WHEN id IS NULL THEN 'null_id' END, CASE WHEN kind IS NULL THEN 'null_kind' END) AS fail_reason FROM dirty""")
def dq_required_keys_rows(t: Tables):
    """Every row of both sides, those that pass with an empty reason."""
    sides = Q.split_required(dirty_events(t), ["id", "kind"], RUN_DATE)
    columns = ["event_id", "id", "kind"]
    return sides.valid.select(*columns, F.lit("").alias("fail_reason")).unionByName(sides.quarantine.select(*columns, "fail_reason"))


@query(f"""WITH {_DIRTY}, bad AS (SELECT event_id, id, kind FROM dirty WHERE id IS NULL OR kind IS NULL), good AS (SELECT event_id, id, kind FROM dirty WHERE id IS NOT NULL AND kind IS NOT NULL)
    SELECT 'validated' AS side, event_id, id, kind, 1 AS times, (SELECT count(*) FROM good) AS written FROM good
    UNION ALL SELECT 'quarantine', event_id, id, kind, 2, (SELECT count(*) FROM bad) FROM bad""")
def dq_write_split(t: Tables):
    """The split written twice: the validated table is replaced, the quarantine grows; counts are those of the last write."""
    sides = Q.split_required(dirty_events(t), ["id", "kind"], RUN_DATE)
    valid, bad = scratch_path(t.spark, "validated"), scratch_path(t.spark, "quarantine")
    for _ in range(2):
        written = writers.write_split(sides.valid, sides.quarantine, valid, bad)
    out = None
    for side, path, n in zip(("validated", "quarantine"), (valid, bad), written):
        rows = writers.read_evolved(t.spark, path).groupBy("event_id", "id", "kind").agg(F.count("*").cast("int").alias("times"))
        part = rows.select(F.lit(side).alias("side"), "event_id", "id", "kind", "times", F.lit(n).cast("long").alias("written"))
        out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT film_id, title, vote_count FROM movies WHERE imdb_id = (SELECT max(imdb_id) FROM movies)""", "movies")
def dq_spot_check(t: Tables):
    known = t.movies.agg(F.max("imdb_id")).first()[0]
    return Q.spot_check(t.movies, "imdb_id", known, ["film_id", "title", "vote_count"])


@query("""
    SELECT count(*) FILTER (WHERE NOT regexp_matches(imdb_id, '^tt[0-9]+$')) AS bad_imdb_id,
           count(*) FILTER (WHERE cast("startYear" AS int) NOT BETWEEN 2000 AND 2030) AS bad_year
    FROM wikidata_ids JOIN basics ON tconst = imdb_id""", "wikidata_ids basics")
def dq_link_soft_counts(t: Tables):
    linked = t.wikidata_ids.join(t.basics.select(F.col("tconst").alias("imdb_id"), F.col("startYear").alias("year")), "imdb_id")
    return Q.soft_counts(linked, Q.link_soft_checks())


@query(f"""WITH {_DIRTY}, c AS (SELECT count(*) AS raw, count(*) FILTER (WHERE id IS NOT NULL AND kind IS NOT NULL) AS validated,
        count(*) FILTER (WHERE id IS NULL OR kind IS NULL) AS quarantined FROM dirty),
    l AS (SELECT count(*) AS raw, count(*) FILTER (WHERE l_quantity >= 5) AS validated, count(*) FILTER (WHERE l_quantity < 5) AS quarantined FROM lineitem)
    SELECT 'events' AS table_name, raw, validated, quarantined, round(quarantined * 100.0::double / (validated + quarantined), 4) AS pct_bad FROM c
    UNION ALL
    SELECT 'lines', raw, validated, quarantined, round(quarantined * 100.0::double / (validated + quarantined), 4) FROM l""")
def dq_summary(t: Tables):
    events = Q.split_required(dirty_events(t), ["id", "kind"], RUN_DATE)
    lines = Q.split(t.lineitem, [Q.Rule("small", F.col("l_quantity") >= 5)], RUN_DATE)
    return Q.summary(t.spark, {"events": events, "lines": lines})


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_uniqueness(t: Tables):
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(f"WITH {_DIRTY} SELECT count(*) FILTER (WHERE id IS NULL) AS null_id, count(*) FILTER (WHERE kind IS NULL) AS null_kind FROM dirty")
def dq_null_keys(t: Tables):
    return Q.null_counts(dirty_events(t), ["id", "kind"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def dq_value_distribution(t: Tables):
    return Q.value_distribution(t.events, ["event_type"])


@query("""SELECT lang, count(*) AS orphans FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY lang""")
def dq_orphans(t: Tables):
    return Q.orphans(t.documents, t.labels, "doc_id").groupBy("lang").agg(F.count("*").alias("orphans"))


@query("""
    SELECT count(*) AS total, count(l.doc_id) AS labelled, count(*) FILTER (WHERE coalesce(quality = 1, false)) AS good,
           round(count(l.doc_id) * 100.0::double / count(*), 4) AS labelled_pct,
           round(count(*) FILTER (WHERE coalesce(quality = 1, false)) * 100.0::double / count(*), 4) AS good_pct
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def coverage_report(t: Tables):
    joined = t.documents.select("doc_id").join(t.labels.withColumn("labelled", F.lit(True)), "doc_id", "left")
    return Q.coverage(joined, {"labelled": F.col("labelled"), "good": F.col("quality") == 1})


# ---- flatten ---------------------------------------------------------------------------


@query("""
    SELECT film_id, imdb_id, cast(release_date AS string) AS release_date, runtime, budget, revenue, vote_count FROM (
        SELECT id AS film_id, nullif(imdb_id, '') AS imdb_id, cast(release_date AS date) AS release_date, runtime, budget, revenue,
               vote_count, row_number() OVER (PARTITION BY id ORDER BY load_ts DESC, delivery, source, vote_count, popularity, vote_average, revenue) AS rn
        FROM films_raw) WHERE rn = 1""", "films_raw")
def typed_projection(t: Tables):
    fields = {
        "film_id": S.long_or_null("id"),
        "imdb_id": S.empty_to_null("imdb_id"),
        "release_date": S.to_date10("release_date").cast("string"),
        "runtime": S.int_or_null("runtime"),
        "budget": S.long_or_null("budget"),
        "revenue": S.long_or_null("revenue"),
        "vote_count": S.int_or_null("vote_count"),
    }
    return X.project(D.latest_per_key(t.films_raw, ["id"], "load_ts", raw_ties()), fields, ["film_id"])


def raw_ties():
    """A total order over film snapshots delivered at the same time."""
    return [F.col(c).asc() for c in ("delivery", "source", "vote_count", "popularity", "vote_average", "revenue")]


def _tagged_parts(t: Tables):
    words = F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("id"), F.upper(w).alias("name")))
    return t.part.select(F.col("p_partkey").alias("id"), words.alias("genres"), F.array(F.col("p_brand"), F.lit(" "), F.col("p_type"), F.col("p_brand")).alias("also"))


def _genre_parts(t: Tables):
    dim = {"genre_id": F.col("item.id"), "genre_name": F.col("item.name")}
    return X.dim_and_bridge(_tagged_parts(t), F.col("id").alias("film_id"), "genres", dim, "genre_id", "film_id")


@query("SELECT genre_id, genre_name FROM genres", "genres")
def explode_dim(t: Tables):
    return _genre_parts(t)[0]


@query("SELECT film_id, genre_id FROM film_genres", "film_genres")
def explode_bridge(t: Tables):
    return _genre_parts(t)[1]


@query("SELECT DISTINCT p_partkey AS person_id, unnest([p_brand, p_type]) AS alias FROM part")
def explode_aliases(t: Tables):
    return X.aliases(_tagged_parts(t), F.col("id").alias("person_id"), "also", "person_id")


@query("""SELECT DISTINCT l_orderkey AS film_id, l_linenumber AS cast_order, l_partkey AS person_id, l_returnflag AS username FROM lineitem""")
def nested_struct_flatten(t: Tables):
    """Credits arrive nested per film and leave as rows; the nesting is per film and
    supplier, so that no film's whole credit list is one value."""
    details = F.struct(F.col("l_returnflag").alias("username"))
    credit = F.struct(F.col("l_linenumber").alias("order"), F.col("l_partkey").alias("id"), details.alias("author_details"))
    nested = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.collect_set(credit).alias("cast"))
    items = X.exploded(nested, F.col("l_orderkey").alias("film_id"), "cast")
    return items.select(
        "film_id", F.col("item.order").alias("cast_order"), F.col("item.id").alias("person_id"),
        F.col("item.author_details.username").alias("username"),
    ).distinct()


@query("""
    SELECT country_iso, max(country_name) AS country_name FROM (
        SELECT n_nationkey AS country_iso, n_name AS country_name FROM nation WHERE n_regionkey <> 1
        UNION ALL SELECT s_nationkey, NULL FROM supplier UNION ALL SELECT c_nationkey, NULL FROM customer) GROUP BY country_iso""")
def conform_dim(t: Tables):
    named = t.nation.filter("n_regionkey <> 1").select(F.col("n_nationkey").alias("country_iso"), F.col("n_name").alias("country_name"))
    nameless = [
        df.select(F.col(c).alias("country_iso"), S.typed_null("string").alias("country_name"))
        for df, c in ((t.supplier, "s_nationkey"), (t.customer, "c_nationkey"))
    ]
    return X.conform("country_iso", "country_name", named, *nameless)


@query("""
    SELECT l_partkey AS film_id, l_suppkey AS country_iso, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS certification,
           CASE WHEN l_linestatus = 'O' THEN year(l_shipdate) END AS release_year, min(l_orderkey) AS first_order
    FROM lineitem GROUP BY ALL""")
def natural_key_dedup(t: Tables):
    releases = t.lineitem.select(
        F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("country_iso"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("certification"),
        F.when(F.col("l_linestatus") == "O", F.year("l_shipdate").cast("bigint")).alias("release_year"),
        F.col("l_orderkey").alias("first_order"),
    )
    return D.first_per_key(releases, ["film_id", "country_iso", "certification", "release_year"], [F.col("first_order")])


# ---- scalars and predicates ---------------------------------------------------------------


@query("""
    WITH d AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN cast(cast(o_orderdate AS date) AS string) || 'T00:00:00.000Z'
            WHEN 'O' THEN '2024-13-01' ELSE ' ' END AS released,
            CASE o_orderstatus WHEN 'F' THEN ' ' || o_orderpriority || ' ' WHEN 'O' THEN '   ' END AS tagline,
            CASE WHEN o_orderpriority = '5-LOW' THEN 'abc' ELSE cast(o_orderkey AS string) END AS runtime, o_totalprice, o_custkey,
            o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS maybe_order FROM orders)
    SELECT o_orderkey, cast(try_cast(left(released, 10) AS date) AS string) AS released_on,
           CASE WHEN trim(tagline) <> '' THEN tagline END AS tagline, try_cast(runtime AS int) AS runtime,
           cast(year(o_orderdate) AS int) AS order_year, left(cast(o_orderdate AS string), 4) AS year_text,
           cast(cast(o_orderdate AS date) - 540 AS string) AS refreshed_from, cast(cast(o_orderdate AS date) + 1 AS string) AS next_day,
           epoch_us(date_trunc('day', o_orderdate)) AS loaded_us, round(o_custkey / 100.0::double, 2) AS confidence,
           coalesce(maybe_order, 999) AS billing, CAST(NULL AS double) AS nothing, o_custkey IS NOT DISTINCT FROM maybe_order AS same,
           concat_ws(' & ', trim(o_orderkey::string), runtime) AS joined, split_part('http://kb/entity/Q' || o_orderkey, '/', 5) AS entity
    FROM d""")
def clean_scalars(t: Tables):
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    released = F.when(status == "F", F.concat(day, F.lit("T00:00:00.000Z"))).when(status == "O", F.lit("2024-13-01")).otherwise(F.lit(" "))
    tagline = F.when(status == "F", F.concat(F.lit(" "), "o_orderpriority", F.lit(" "))).when(status == "O", F.lit("   "))
    runtime = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("abc")).otherwise(key)
    maybe = F.when(status != "P", F.col("o_custkey"))
    return t.orders.select(
        "o_orderkey",
        S.to_date10(released).cast("string").alias("released_on"),
        S.empty_to_null(tagline).alias("tagline"),
        S.int_or_null(runtime).alias("runtime"),
        F.year("o_orderdate").alias("order_year"),
        S.year_text("o_orderdate").alias("year_text"),
        F.date_sub(F.col("o_orderdate").cast("date"), 540).cast("string").alias("refreshed_from"),
        F.date_add(F.col("o_orderdate").cast("date"), 1).cast("string").alias("next_day"),
        F.unix_micros(S.to_timestamp_or_null(F.concat(day, F.lit("T00:00:00Z")))).alias("loaded_us"),
        F.round(F.col("o_custkey") / 100.0, 2).alias("confidence"),
        F.coalesce(maybe, F.lit(999).cast("bigint")).alias("billing"),
        S.typed_null("double").alias("nothing"),
        F.col("o_custkey").eqNullSafe(maybe).alias("same"),
        F.concat_ws(" & ", key, runtime).alias("joined"),
        S.uri_tail(F.concat(F.lit("http://kb/entity/Q"), key)).alias("entity"),
    )


@query("""
    SELECT p_partkey, regexp_matches('tt' || p_partkey, '^tt[0-9]+$') AS good_key, p_size BETWEEN 10 AND 20 AS mid,
           p_type IN ('PROMO', 'LARGE') AS listed, p_name ILIKE '%ReD%' AS red, lower(p_type) = 'small' AS small,
           CASE p_type WHEN 'PROMO' THEN 1 WHEN 'LARGE' THEN 2 ELSE 3 END AS rank,
           contains(lower(p_name), 'gear') AS gear, p_name ILIKE '%d_r%' AS wild FROM part""")
def predicate_suite(t: Tables):
    kind = F.col("p_type")
    return t.part.select(
        "p_partkey",
        S.is_title_key(F.concat(F.lit("tt"), F.col("p_partkey").cast("string"))).alias("good_key"),
        F.col("p_size").between(10, 20).alias("mid"),
        kind.isin("PROMO", "LARGE").alias("listed"),
        S.contains_ci("p_name", "ReD").alias("red"),
        (F.lower(kind) == "small").alias("small"),
        F.when(kind == "PROMO", 1).when(kind == "LARGE", 2).otherwise(3).alias("rank"),
        S.contains_ci("p_name", "GEAR", wildcards=False).alias("gear"),
        S.contains_ci("p_name", "d_r").alias("wild"),
    )


@query(r"""
    SELECT doc_id, trim(lower(regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'), '[^a-zA-Z0-9]+', ' ', 'g'))) AS name
    FROM documents""")
def name_normalise(t: Tables):
    return t.documents.select("doc_id", N.normalise_name("text").alias("name"))


# ---- joins, aggregates, set operations -------------------------------------------------------


_PEOPLE_KEYS = "(SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 400000)"


@query(f"""
    SELECT 'inner' AS kind, count(*) AS n, cast(sum(o_orderkey) AS bigint) AS checksum FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0
    UNION ALL SELECT 'chain', count(*), cast(sum(l_linenumber) AS bigint) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1
    UNION ALL SELECT 'left', count(*), cast(sum(coalesce(quality, 7)) AS bigint) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    UNION ALL SELECT 'anti', count(*), cast(sum(c_custkey) AS bigint) FROM customer WHERE c_custkey NOT IN (SELECT k FROM {_PEOPLE_KEYS})
    UNION ALL SELECT 'semi_nested', count(*), cast(sum(l_partkey) AS bigint) FROM lineitem WHERE l_orderkey IN (
        SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT k FROM {_PEOPLE_KEYS}))
    UNION ALL SELECT 'theta', count(*), cast(sum(n_nationkey) AS bigint) FROM nation WHERE n_nationkey <> (SELECT max(s_nationkey) FROM supplier)
    UNION ALL SELECT 'null_safe', count(*), cast(sum(a.doc_id) AS bigint) FROM
        (SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) a
        JOIN (SELECT DISTINCT quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) b ON a.quality IS NOT DISTINCT FROM b.quality""")
def join_suite(t: Tables):
    line = lambda kind, df, c: df.agg(F.count("*").alias("n"), F.sum(c).cast("bigint").alias("checksum")).select(F.lit(kind).alias("kind"), "n", "checksum")
    customers = t.customer.withColumnRenamed("c_custkey", "o_custkey")
    wanted = t.orders.filter("o_totalprice > 400000").select("o_custkey").distinct()
    orders = t.orders.withColumnRenamed("o_orderkey", "l_orderkey")
    labelled = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    qualities = labelled.select(F.col("quality").alias("q")).distinct()
    chain = t.lineitem.join(orders, "l_orderkey").join(customers, "o_custkey")
    parts = [
        line("inner", t.orders.join(customers.filter("c_acctbal > 0"), "o_custkey"), "o_orderkey"),
        line("chain", chain.join(t.nation.filter("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey")), "l_linenumber"),
        line("left", labelled.withColumn("q", F.coalesce("quality", F.lit(7))), "q"),
        line("anti", customers.join(wanted, "o_custkey", "left_anti"), "o_custkey"),
        line("semi_nested", t.lineitem.join(orders.join(wanted, "o_custkey", "left_semi"), "l_orderkey", "left_semi"), "l_partkey"),
        line("theta", t.nation.filter(F.col("n_nationkey") != t.supplier.agg(F.max("s_nationkey")).scalar()), "n_nationkey"),
        line("null_safe", labelled.join(qualities, F.col("quality").eqNullSafe(F.col("q"))), "doc_id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""SELECT l_orderkey, l_linenumber, l_partkey, p_name, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey""")
def skewed_join(t: Tables):
    """Join that splits the part keys with the most lines."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    hot = skew.hot_keys(lines, "l_partkey", min_rows=35)
    return skew.skew_join(lines, parts, ["l_partkey"], hot=hot).select("l_orderkey", "l_linenumber", "l_partkey", "p_name", "l_quantity")


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers,
           epoch_us(min(l_shipdate)) AS first_us, epoch_us(max(l_shipdate)) AS last_us, sum(l_quantity) AS quantity,
           round(avg(l_quantity), 4) AS avg_quantity, count(*) FILTER (WHERE l_linenumber > 3) AS late_lines,
           cast(sum(CASE WHEN l_tax > 0.02 THEN 1 ELSE 0 END) AS bigint) AS taxed, max(CASE WHEN l_linenumber = 7 THEN l_suppkey END) AS any_label,
           count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_partkey END) AS f_parts
    FROM lineitem GROUP BY ALL HAVING count(*) > 20 ORDER BY n DESC""")
def agg_suite(t: Tables):
    return (
        t.lineitem.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("n"),
            F.countDistinct("l_suppkey").alias("suppliers"),
            F.unix_micros(F.min("l_shipdate").cast("timestamp")).alias("first_us"),
            F.unix_micros(F.max("l_shipdate").cast("timestamp")).alias("last_us"),
            F.sum("l_quantity").alias("quantity"),
            F.round(F.avg("l_quantity"), 4).alias("avg_quantity"),
            F.count_if(F.col("l_linenumber") > 3).alias("late_lines"),
            F.sum(F.when(F.col("l_tax") > 0.02, 1).otherwise(0)).alias("taxed"),
            F.max(F.when(F.col("l_linenumber") == 7, F.col("l_suppkey"))).alias("any_label"),
            F.countDistinct(F.when(F.col("l_linestatus") == "F", F.col("l_partkey"))).alias("f_parts"),
        )
        .filter(F.col("n") > 20)
        .orderBy(F.desc("n"))
    )


@query("""
    WITH modes AS (SELECT l_suppkey, string_agg(l_linenumber::string, ' & ' ORDER BY rn) AS top_two FROM (
        SELECT l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_linenumber) AS rn
        FROM lineitem GROUP BY l_suppkey, l_linenumber) WHERE rn <= 2 GROUP BY l_suppkey)
    SELECT l_suppkey, top_two, l_partkey AS best_part FROM modes JOIN (
        SELECT l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_partkey DESC) AS rn
        FROM lineitem) b USING (l_suppkey) WHERE rn = 1""")
def agg_modes_argmax(t: Tables):
    counts = t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("n"))
    top = skew.top_per_group(counts, ["l_suppkey"], [F.desc("n"), F.col("l_linenumber")], 2, "rn")
    packed = F.array_sort(F.collect_list(F.struct("rn", F.col("l_linenumber").cast("string").alias("v"))))
    modes = top.groupBy("l_suppkey").agg(F.array_join(F.transform(packed, lambda s: s["v"]), " & ").alias("top_two"))
    best = t.lineitem.groupBy("l_suppkey").agg(F.max_by("l_partkey", F.struct("l_extendedprice", "l_partkey")).alias("best_part"))
    return modes.join(best, "l_suppkey")


@query("""
    SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'union_distinct', count(*) FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)
    UNION ALL SELECT 'padded', count(*) FROM (SELECT c_nationkey AS k, c_mktsegment AS seg FROM customer UNION ALL SELECT s_nationkey, NULL FROM supplier) WHERE seg IS NULL
    UNION ALL SELECT 'except', count(*) FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F')
    UNION ALL SELECT 'intersect', count(*) FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O' INTERSECT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F')
    UNION ALL SELECT 'distinct', count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)""")
def setop_suite(t: Tables):
    c, s = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    pairs = t.lineitem.select("l_partkey", "l_suppkey", "l_linestatus")
    opened = pairs.filter("l_linestatus = 'O'").drop("l_linestatus")
    closed = pairs.filter("l_linestatus = 'F'").drop("l_linestatus")
    padded = t.customer.select(F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("seg")).unionByName(s, allowMissingColumns=True)
    sets = {
        "union": c.union(s),
        "union_distinct": c.union(s).distinct(),
        "padded": padded.filter("seg is null"),
        "except": opened.subtract(closed),
        "intersect": opened.intersect(closed),
        "distinct": pairs.drop("l_linestatus").distinct(),
    }
    out = None
    for name, df in sets.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("""SELECT count(*) AS joined_rows, (SELECT count(*) FROM based_on WHERE imdb_id IN (SELECT imdb_id FROM wikidata_ids)) AS matched_rows
    FROM based_on JOIN wikidata_ids USING (imdb_id)""", "based_on wikidata_ids")
def match_count(t: Tables):
    return Q.match_count(t.based_on, "imdb_id", t.wikidata_ids, "imdb_id")
