"""Landing, reading back, lineage and incremental loads.

Queries that need files write the whole given table to a fresh folder under the shared
checkpoint directory and read it back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import incremental as I
from ..operators.dedup import latest_per_key
from ..session import scratch_path
from ..sources import lineage, readers, report, writers
from .quality_queries import micros
from .registry import Tables, query

# ---- sources and sinks -----------------------------------------------------------------


@query("""
    SELECT 'tt' || p_partkey AS tconst, CASE WHEN p_size > 25 THEN '"' || p_name ELSE p_name || ' "x" \\ y' END AS title,
           CASE WHEN p_type <> 'PROMO' THEN cast(p_size AS string) END AS runtime
    FROM part WHERE p_size > 3""")
def read_tsv_nulls(t: Tables):
    path = scratch_path(t.spark, "tsv")
    title = F.when(F.col("p_size") > 25, F.concat(F.lit('"'), "p_name")).otherwise(F.concat("p_name", F.lit(' "x" \\ y')))
    rows = t.part.select(
        F.concat(F.lit("tt"), F.col("p_partkey").cast("string")).alias("tconst"),
        title.alias("title"),
        F.when(F.col("p_type") != "PROMO", F.col("p_size").cast("string")).alias("runtime"),
        F.col("p_size").cast("string").alias("size"),
    )
    writers.land_tsv(rows, path)
    schema = "tconst string, title string, runtime string, size string"
    return readers.tsv(t.spark, path, schema, keep=F.col("size").try_cast("int") > 3, drop=["size"])


def _landed_parts(t: Tables, **extra):
    path = scratch_path(t.spark, "json")
    rows = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
        F.when(F.col("p_size") > 25, F.struct(F.col("p_size").alias("id"), F.col("p_brand").alias("name"))).alias("collection"),
        F.col("p_retailprice").alias("budget"),
    )
    writers.land_json(rows, path)
    return path


@query("""SELECT p_partkey AS id, p_name AS title, p_retailprice AS budget,
    CASE WHEN p_size > 25 THEN p_brand END AS collection_name FROM part""")
def read_jsonl_inferred(t: Tables):
    df = lineage.stringify(readers.json_inferred(t.spark, _landed_parts(t)), "collection")
    return df.select("id", "title", "budget", F.get_json_object("collection", "$.name").alias("collection_name"))


@query("""SELECT p_partkey AS id, p_name AS title, CAST(NULL AS string) AS tagline, true AS has_file FROM part""")
def read_jsonl_enforced(t: Tables):
    fields = [T.StructField("id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("tagline", T.StringType())]
    table_schema = T.StructType([*fields, T.StructField("load_ts", T.TimestampType())])
    df = readers.with_source_file(readers.json_enforced(t.spark, _landed_parts(t), table_schema))
    return df.select("id", "title", "tagline", F.col("source_file").endswith(".json").alias("has_file"))


@query("""SELECT l_suppkey, count(*) AS n, cast(sum(l_linenumber) AS bigint) AS lines FROM lineitem
    WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) GROUP BY l_suppkey""")
def read_files_for_keys(t: Tables):
    """One folder per supplier; only those of the wanted suppliers count."""
    path = scratch_path(t.spark, "keyed")
    rows = t.lineitem.select("l_suppkey", F.col("l_suppkey").alias("key"), "l_linenumber")
    writers.dealt_by_files(rows, "key").write.partitionBy("key").json(path)
    wanted = t.supplier.filter("s_acctbal > 5000").select("s_suppkey")
    landed = t.spark.read.schema("l_suppkey bigint, l_linenumber int, key bigint").json(path)
    kept = readers.files_of_keys(landed, wanted, "s_suppkey", "key")
    return kept.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


def _mixed_files(t: Tables) -> str:
    """Event documents as landed: of errors cut off in the middle, of a hundredth of the purchases one indented
    object per file, of the rest one object per line, those of purchases in a folder of their own."""
    path = scratch_path(t.spark, "mixed")
    doc = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "props": '), "props", F.lit("}"))
    broken = F.when(F.col("event_type") == "error", F.expr("left(doc, length(doc) - 4)")).otherwise(F.col("doc"))
    docs = t.events.withColumn("doc", doc).withColumn("value", broken)
    alone = F.coalesce((F.col("event_type") == "purchase") & (F.col("event_id") % 100 == 0), F.lit(False))
    docs.filter("event_type <> 'purchase'").select("value").write.text(f"{path}/lines")
    docs.filter("event_type = 'purchase'").filter(~alone).select("value").write.text(f"{path}/purchases")
    indented = F.concat(F.lit('{\n  "event_id": '), F.col("event_id").cast("string"), F.lit(',\n  "props": '), "props", F.lit("\n}"))
    docs.filter(alone).select(indented.alias("value"), F.col("event_id").alias("part")).write.partitionBy("part").text(f"{path}/objects")
    return path


def _read_mixed(t: Tables, path: str, *kinds: str):
    parts = [readers.json_tolerant(t.spark, f"{path}/{kind}", _MIXED_SCHEMA, glob="*.txt") for kind in kinds]
    return reduce(lambda a, b: a.unionByName(b), parts).select("event_id", F.col("props.k").alias("k"))


_MIXED_SCHEMA = "event_id bigint, props struct<k:bigint>"


@query("""SELECT event_id, cast(json_extract(props, '$.k') AS bigint) AS k FROM events WHERE event_type <> 'error'""")
def corrupt_record_filter(t: Tables):
    """Every event that isn't cut off, the indented objects among them."""
    return _read_mixed(t, _mixed_files(t), "lines", "purchases", "objects")


@query("""SELECT event_id, cast(json_extract(props, '$.k') AS bigint) AS k FROM events WHERE event_type <> 'error'""")
def corrupt_record_every_event(t: Tables):
    """The same question under its later name."""
    return corrupt_record_filter(t)


@query("""SELECT left(doc, length(doc) - 4) AS rejected, count(*) AS n FROM (
    SELECT '{"event_id": ' || event_id || ', "props": ' || props || '}' AS doc FROM events WHERE event_type = 'error') GROUP BY ALL""")
def corrupt_record_quarantine(t: Tables):
    """The cut-off documents themselves."""
    return readers.json_rejected(t.spark, f"{_mixed_files(t)}/lines", _MIXED_SCHEMA, glob="*.txt").groupBy("rejected").agg(F.count("*").alias("n"))


@query("""SELECT c_custkey AS film, 'Q' || n_nationkey AS country, n_name AS label FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def sparql_bindings_flatten(t: Tables):
    """One result document per nation with a binding for each of its customers' pages,
    so no document holds more than a page of bindings."""
    uri = lambda kind, c: F.concat(F.lit(f"http://kb/{kind}/"), c)
    value = lambda c: F.struct(c.alias("value"))
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    binding = F.struct(
        value(uri("film", F.col("c_custkey").cast("string"))).alias("film"),
        value(uri("country", F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")))).alias("country"),
        value(F.col("n_name")).alias("label"),
    )
    page = F.floor(F.col("c_custkey") / 100)
    pages = joined.groupBy("n_nationkey", page.alias("page")).agg(F.collect_list(binding).alias("bindings"))
    docs = pages.select(F.to_json(F.struct(F.struct("bindings").alias("results"))).alias("body"))
    rows = readers.sparql_bindings(docs, "body", {"film": "film", "country": "country", "label": "label"}, ids=["film", "country"])
    return rows.withColumn("film", S.long_or_null("film"))


@query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def sink_append_evolve(t: Tables):
    path = scratch_path(t.spark, "evolve")
    writers.append(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), path)
    writers.append(t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    return writers.read_evolved(t.spark, path).select("o_orderkey", "o_orderstatus", "o_orderpriority")



@query("""SELECT o_orderstatus, count(*) AS rows_written, count(*) AS rows_read FROM orders GROUP BY ALL""")
def sink_append_counts(t: Tables):
    """What each append says it has written, beside what is in the table."""
    path = scratch_path(t.spark, "counted")
    states = sorted(r[0] for r in t.orders.select("o_orderstatus").distinct().collect())  # three
    said = [(s, writers.append(t.orders.filter(F.col("o_orderstatus") == s), path)) for s in states]
    read = t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("rows_read"))
    return read.join(t.spark.createDataFrame(said, "o_orderstatus string, rows_written bigint"), "o_orderstatus")


@query("""SELECT user_id, strftime(ts, '%Y-%m-%d') AS snapshot_date, max(epoch_us(ts)) AS last_us FROM events WHERE ts >= '2024-01-20' GROUP BY ALL""")
def snapshots_landed(t: Tables):
    """Daily states appended date by date in two runs and read back from some date on."""
    path = scratch_path(t.spark, "snapshots")
    daily = I.snapshot_per_day(t.events, "user_id", "ts", [F.col("event_id")]).select("user_id", "snapshot_date", micros("ts").alias("last_us"))
    for late in (False, True):
        writers.land_snapshots(daily.filter((F.col("snapshot_date") >= "2024-01-25") == F.lit(late)), path)
    landed = t.spark.read.schema("user_id bigint, last_us bigint, snapshot_date string").parquet(path)
    return landed.filter("snapshot_date >= '2024-01-20'").select("user_id", "snapshot_date", "last_us")


@query("SELECT s_suppkey, s_name FROM supplier")
def sink_overwrite_guarded(t: Tables):
    """A full table survives an empty delivery and is replaced, schema included, by a full one."""
    path = scratch_path(t.spark, "guarded")
    writers.overwrite(t.nation, path)
    replaced = writers.overwrite_unless_empty(t.supplier.select("s_suppkey", "s_name"), path)
    kept = not writers.overwrite_unless_empty(t.supplier.filter("s_suppkey < 0"), path)
    assert replaced and kept
    return t.spark.read.parquet(path)


@query("""SELECT cast(cast(ts AS date) AS string) AS snapshot_date, count(*) AS n, sum(user_id)::bigint AS users
    FROM events WHERE ts >= '2024-01-15' GROUP BY ALL""")
def sink_partitioned_batches(t: Tables):
    """Snapshots land by date; the date filter reads only the folders it names."""
    path = scratch_path(t.spark, "daily")
    dated = t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("snapshot_date"))
    writers.land_json(dated, path, 10_000, ["snapshot_date"])
    landed = t.spark.read.schema("user_id bigint, snapshot_date string").json(path)
    recent = landed.filter(F.col("snapshot_date") >= "2024-01-15")
    return recent.groupBy("snapshot_date").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def resume_load(t: Tables):
    """A load broken off after the shipped orders is run again from the start."""
    path = scratch_path(t.spark, "resume")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.append(rows.filter("o_orderstatus = 'F'"), path)
    writers.resume_load(rows, path, ["o_orderkey"])
    writers.resume_load(rows, path, ["o_orderkey"])
    return t.spark.read.parquet(path).select("o_orderkey", "o_totalprice")


@query("""SELECT s_suppkey AS id, '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || '}' AS node FROM supplier""")
def nested_export(t: Tables):
    path = scratch_path(t.spark, "export")
    writers.documents(t.supplier, ["s_suppkey", "s_name", "s_nationkey"]).write.text(path)
    lines = t.spark.read.text(path).withColumnRenamed("value", "node")
    return lines.select(F.get_json_object("node", "$.s_suppkey").cast("bigint").alias("id"), "node")


@query("""
    SELECT 'customer' AS table_name, count(*) AS row_count, CAST(NULL AS bigint) AS last_us FROM customer
    UNION ALL SELECT 'events', count(*), epoch_us(max(ts)) FROM events
    UNION ALL SELECT 'lineitem', count(*), epoch_us(max(l_shipdate)) FROM lineitem
    UNION ALL SELECT 'orders', count(*), epoch_us(max(o_orderdate)) FROM orders""")
def table_report(t: Tables):
    tables = {n: getattr(t, n) for n in ("customer", "events", "lineitem", "orders")}
    ts = {"events": "ts", "lineitem": "l_shipdate", "orders": "o_orderdate"}
    return report.table_report(tables, ts).select("table_name", "row_count", micros("last_load").alias("last_us"))


# ---- lineage and schema ------------------------------------------------------------------


@query("""SELECT p_partkey, 'catalog' AS source_system, 'parts' AS source_endpoint, 'part.parquet' AS source_file,
    epoch_us(TIMESTAMP '2024-02-01 00:00:00') AS load_us, CAST('p' AS string) AS method, 1.0::double AS confidence FROM part""")
def bronze_lineage(t: Tables):
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    df = lineage.stamp_bronze(t.part.select("p_partkey"), "catalog", "parts", "part.parquet", stamp)
    df = lineage.with_constants(df, method="p", confidence=1.0)
    df = df.withColumn("load_us", micros("load_ts"))
    return df.drop("load_ts")


@query("""SELECT s_suppkey, 'catalog' AS source_system, 'suppliers' AS source_endpoint, CAST(NULL AS string) AS source_file FROM supplier""")
def silver_lineage(t: Tables):
    return lineage.stamp_silver(t.supplier.select("s_suppkey"), "catalog", "suppliers").drop("loaded_at")


@query("""SELECT try_cast(o_orderpriority AS int) AS priority, o_orderkey AS key, cast(o_totalprice AS string) IS NOT NULL AS has_total,
    CAST(NULL AS string) AS note FROM orders""")
def bronze_schema_align(t: Tables):
    target = T.StructType(
        [
            T.StructField("priority", T.IntegerType()),
            T.StructField("key", T.LongType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("note", T.StringType()),
        ]
    )
    batch = t.orders.select(
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_totalprice").cast("string").alias("total"),
        F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("surplus"),
    )
    aligned = lineage.align_to(batch, target)
    return aligned.select("priority", "key", F.col("total").isNotNull().alias("has_total"), "note")


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS bigint) AS k, json_extract_string(props, '$.x') AS x FROM events")
def json_path_extract(t: Tables):
    return t.events.select(
        "event_id", S.long_or_null(F.get_json_object("props", "$.k")).alias("k"), F.get_json_object("props", "$.x").alias("x")
    )


@query("SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS total FROM orders")
def json_struct_roundtrip(t: Tables):
    packed = t.orders.select("o_orderkey", F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total")).alias("doc"))
    text = lineage.stringify(packed, "doc")
    parsed = text.withColumn("doc", F.from_json("doc", "status string, total double"))
    return parsed.select("o_orderkey", "doc.status", "doc.total")


# ---- incremental loads --------------------------------------------------------------------

_EARLY = "o_orderdate < '1998-06-01'"


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE {_EARLY})")
def new_key_guard(t: Tables):
    return I.new_keys(t.orders.select("o_orderkey", "o_totalprice"), t.orders.filter(_EARLY), ["o_orderkey"])


@query(f"""SELECT o_orderkey FROM orders WHERE cast(o_orderdate AS date) >= (SELECT cast(max(o_orderdate) AS date) FROM orders WHERE {_EARLY})""")
def watermark_filter(t: Tables):
    mark = I.watermark(t.orders.filter(_EARLY), "o_orderdate")
    return I.changed_since(t.orders, "o_orderdate", mark).select("o_orderkey")


@query("SELECT count(*) AS n FROM orders")
def watermark_missing(t: Tables):
    """No stamp on the target table means everything is loaded again."""
    return I.changed_since(t.orders, "o_orderdate", I.watermark(t.nation, "load_ts")).agg(F.count("*").alias("n"))


@query("""SELECT film_id, cast(release_date AS string) AS release_date FROM movies
    WHERE release_date BETWEEN DATE '2000-06-15' AND DATE '2012-01-01' AND vote_count >= 200""", "movies")
def discover_between(t: Tables):
    found = I.discover(t.movies, "release_date", F.lit("2000-06-15").cast("date"), F.lit("2012-01-01").cast("date"), 200)
    return found.select("film_id", F.col("release_date").cast("string").alias("release_date"))


@query("""SELECT o_orderkey FROM orders
    WHERE cast(o_orderdate AS date) >= (SELECT cast(max(o_orderdate) AS date) - 540 FROM orders)""")
def refresh_window(t: Tables):
    return I.refresh_window(t.orders, "o_orderdate", t.orders.agg(F.max("o_orderdate")).scalar()).select("o_orderkey")


@query("""SELECT tconst FROM basics WHERE cast("startYear" AS int) >= 2023
    UNION SELECT imdb_id FROM movies WHERE vote_count > 900""", "basics movies")
def refresh_set(t: Tables):
    fresh = t.movies.filter("vote_count > 900").select(F.col("imdb_id").alias("tconst"))
    return I.refresh_keys(t.basics, "tconst", "startYear", 2025, fresh)


# Updates: open orders get a new total, and every order's successor in the next key range is new.
_UPDATES = """upd AS (
    SELECT o_orderkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey + m, 'N', o_totalprice, o_orderdate FROM orders, (SELECT max(o_orderkey) + 1 AS m FROM orders) WHERE o_orderstatus = 'P')"""


def _updates(t: Tables):
    opened = t.orders.filter("o_orderstatus = 'O'").select(
        "o_orderkey", F.lit("U").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderdate"
    )
    shift = t.orders.agg(F.max("o_orderkey") + 1).scalar()
    fresh = t.orders.filter("o_orderstatus = 'P'").select(
        (F.col("o_orderkey") + shift).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice", "o_orderdate"
    )
    return opened.unionByName(fresh)


def _target(t: Tables):
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query(f"""WITH {_UPDATES}
    SELECT o_orderkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) AS d FROM upd
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM upd)""")
def merge_scd1(t: Tables):
    twice = _updates(t).unionByName(_updates(t))
    merged = I.merge_scd1(_target(t), twice, ["o_orderkey"], order_by="o_orderdate")
    return merged.withColumn("d", micros("o_orderdate")).drop("o_orderdate")


@query(f"""WITH {_UPDATES}
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM upd WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def merge_insert_only(t: Tables):
    return I.merge_insert_only(_target(t), _updates(t), ["o_orderkey"]).drop("o_orderdate")


_RELEASES = """rel AS (SELECT l_partkey AS film_id, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS certification,
        max(l_quantity) AS q FROM lineitem GROUP BY ALL),
    upd AS (SELECT film_id, certification, -1.0::double AS q FROM rel WHERE certification IS NULL OR certification = 'A')"""


def _releases(t: Tables):
    cert = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("certification")
    return t.lineitem.groupBy(F.col("l_partkey").alias("film_id"), cert).agg(F.max("l_quantity").alias("q"))


@query(f"""WITH {_RELEASES}
    SELECT r.film_id, r.certification, coalesce(u.q, r.q) AS q FROM rel r
    LEFT JOIN upd u ON u.film_id = r.film_id AND u.certification IS NOT DISTINCT FROM r.certification""")
def merge_null_safe(t: Tables):
    rel = _releases(t)
    upd = rel.filter("certification is null or certification = 'A'").withColumn("q", F.lit(-1.0))
    return I.merge_scd1(rel, upd, ["film_id", "certification"], null_safe_keys=["certification"])


@query("""WITH late AS (SELECT o_orderkey, o_orderdate - INTERVAL 1 DAY AS o_orderdate FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, o_orderdate + INTERVAL 1 DAY FROM orders WHERE o_orderstatus = 'O')
    SELECT o.o_orderkey, epoch_us(greatest(o.o_orderdate, l.o_orderdate)) AS d FROM orders o LEFT JOIN late l USING (o_orderkey)""")
def merge_newer_only(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    older = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.expr("o_orderdate - interval 1 day").alias("o_orderdate"))
    newer = t.orders.filter("o_orderstatus = 'O'").select("o_orderkey", F.expr("o_orderdate + interval 1 day").alias("o_orderdate"))
    merged = I.merge_scd1(rows, older.union(newer), ["o_orderkey"], order_by="o_orderdate", newer_only=True)
    return merged.select("o_orderkey", micros("o_orderdate").alias("d"))


@query("""SELECT film_id, epoch_us(snapshot_ts) AS ts_us, popularity, vote_count,
        row_number() OVER (PARTITION BY film_id ORDER BY snapshot_ts DESC) = 1 AS is_current
    FROM (SELECT DISTINCT film_id, snapshot_ts, popularity, vote_count FROM trends)""", "trends")
def scd2_history(t: Tables):
    twice = t.trends.unionByName(t.trends)
    out = I.scd2_history(twice, "film_id", "snapshot_ts", [F.col("popularity")])
    return out.select("film_id", micros("snapshot_ts").alias("ts_us"), "popularity", "vote_count", "is_current")


@query("""SELECT film_id, max(epoch_us(snapshot_ts)) AS ts_us, arg_max(popularity, snapshot_ts) AS popularity, count(*) AS snapshots
    FROM trends GROUP BY film_id""", "trends")
def scd2_current_and_trend(t: Tables):
    history = I.scd2_history(t.trends, "film_id", "snapshot_ts")
    counts = history.groupBy("film_id").agg(F.count("*").alias("snapshots"))
    now = I.current_rows(history).select("film_id", micros("snapshot_ts").alias("ts_us"), "popularity")
    return now.join(counts, "film_id")


@query("""SELECT film_id, epoch_us(snapshot_ts) AS ts_us, status FROM (
        SELECT *, lag(status) OVER w AS prev, row_number() OVER w AS rn FROM trends
        WINDOW w AS (PARTITION BY film_id ORDER BY snapshot_ts)) WHERE rn = 1 OR prev IS DISTINCT FROM status""", "trends")
def scd2_changes_only(t: Tables):
    changes = I.scd2_changes(t.trends, "film_id", "snapshot_ts", ["status"], [F.col("popularity")])
    return changes.select("film_id", micros("snapshot_ts").alias("ts_us"), "status")


@query("""SELECT user_id, snapshot_date, event_id, value FROM (
        SELECT *, cast(cast(ts AS date) AS string) AS snapshot_date,
               row_number() OVER (PARTITION BY user_id, cast(ts AS date) ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def snapshot_daily(t: Tables):
    daily = I.snapshot_per_day(t.events, "user_id", "ts", [F.col("event_id")])
    return daily.select("user_id", "snapshot_date", "event_id", "value")


@query("""SELECT epoch_us(first_load) AS run_us, count(*) AS new_keys FROM (
        SELECT user_id, date_trunc('day', min(ts)) AS first_load FROM events GROUP BY user_id) GROUP BY first_load""")
def first_seen_per_run(t: Tables):
    return I.first_seen_per_run(t.events, "user_id", "ts").select(micros("first_load").alias("run_us"), "new_keys")


@query("SELECT epoch_us(date_trunc('day', ts)) AS run_us, count(*) AS n FROM events GROUP BY ALL")
def activity_per_run(t: Tables):
    return I.activity_per_run(t.events, "ts").select(micros("load_ts").alias("run_us"), "n")


@query(f"""WITH {_UPDATES}, k AS (SELECT o_orderkey IN (SELECT o_orderkey FROM orders) AS known FROM upd)
    SELECT (SELECT count(*) FROM orders) AS rows_before, count(*) FILTER (WHERE NOT known) AS new_rows,
           count(*) FILTER (WHERE known) AS refreshed_rows, (SELECT count(*) FROM orders) + count(*) FILTER (WHERE NOT known) AS rows_after FROM k""")
def run_summary(t: Tables):
    return I.run_summary(t.orders, _updates(t), ["o_orderkey"])


@query("""SELECT DISTINCT l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')""")
def allowlist_semi(t: Tables):
    """In-scope titles restrict the credits, whose people form the next allow-list."""
    titles = t.orders.filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return I.restrict_to(t.lineitem.select("l_orderkey", "l_suppkey"), titles, "l_orderkey").select("l_suppkey").distinct()


@query("""SELECT person_id FROM film_cast WHERE cast_order <= 3
    UNION SELECT person_id FROM film_crew WHERE job IN ('Director', 'Writer')""", "film_cast film_crew")
def people_selection(t: Tables):
    return I.select_people(t.film_cast, t.film_crew, ["Director", "Writer"], 3)


@query("""SELECT user_id, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn <= 3""")
def latest_values(t: Tables):
    return I.latest_values(t.events, "user_id", "ts", 3, [F.col("event_id")]).select("user_id", "event_id")
