import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import dedup as D
from marquee.operators import incremental as I
from marquee.operators import quality as Q
from marquee.sources import readers

T0 = dt.datetime(2024, 1, 1)


def at(day, hour=0):
    return T0 + dt.timedelta(days=day, hours=hour)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_per_key_ties_and_nulls(spark):
    data = [(1, at(0), "a"), (1, at(2), "c"), (1, at(2), "b"), (None, at(1), "x"), (None, at(3), "y")]
    df = spark.createDataFrame(data, "id long, load_ts timestamp, v string")
    out = D.latest_per_key(df, ["id"], ties=[F.col("v")]).select("id", "v")
    assert rows(out) == rows(spark.createDataFrame([(1, "b"), (None, "y")], "id long, v string"))


def test_null_keys_are_not_hidden(spark):
    data = [(1, at(0)), (1, at(1)), (None, at(0)), (None, at(1)), (None, at(2))]
    df = spark.createDataFrame(data, "id long, load_ts timestamp")
    rules = [Q.Rule("null_id", F.col("id").isNotNull())]
    side = Q.dedup_then_split(df, ["id"], rules, "2024-02-01")
    assert side.valid.count() == 1 and side.quarantine.count() == 3
    assert {r.fail_reason for r in side.quarantine.collect()} == {"null_id"}
    assert Q.dedup_then_split(df, ["id"], rules, "x", dedup_first=True).quarantine.count() == 1


def test_hard_rules(spark):
    data = [
        ("tt1", "7.0", "10", "d"), (None, "7.0", "10", "d"), ("xx1", "7.0", "10", "d"), ("tt2", "0.9", "10", "d"), ("tt3", "10.1", "10", "d"),
        ("tt4", None, "10", "d"), ("tt5", "5", None, "d"), ("tt6", "5", "-1", "d"), ("tt7", "abc", "1", "d"), ("xx1", "7.0", "10", "d"),
    ]
    df = spark.createDataFrame(data, "tconst string, averageRating string, numVotes string, snapshot_date string")
    side = Q.split(df, Q.ratings_rules(), "2024-02-01")
    assert [r.tconst for r in side.valid.collect()] == ["tt1"] and side.quarantine.count() == 9
    complement = Q.complement(df, Q.all_pass(Q.ratings_rules()))
    assert rows(complement) == rows(df.subtract(side.valid)) and complement.count() == 8
    years = spark.createDataFrame([("tt1", "a", y) for y in ("1879", "1880", "2030", "2031", "abc", None)], "tconst string, primaryTitle string, startYear string")
    assert sorted(r.startYear for r in Q.split(years, Q.basics_rules(), "x").valid.collect()) == ["1880", "2030"]


def test_soft_counts_keep_nulls_apart(spark):
    df = spark.createDataFrame([("2010-01-01", None, None, "t"), (None, 11.0, -1, None)], "release_date string, vote_average double, runtime int, title string")
    assert Q.soft_counts(df, Q.film_soft_checks("2020-01-01")).first().asDict() == {
        "bad_release": 1, "bad_vote": 1, "negative_runtime": 1, "null_title": 1,
    }


def test_summary_of_nothing(spark):
    none = spark.createDataFrame([], "a int")
    assert tuple(Q.summary(spark, {"t": Q.split(none, [], "x")}).first()) == ("t", 0, 0, 0, 0.0)


def test_merge_scd1(spark):
    schema = "k long, c string, v string, ts timestamp"
    target = spark.createDataFrame([(1, None, "old", at(5)), (2, "A", "keep", at(0)), (3, "A", "old", at(0))], schema)
    source = spark.createDataFrame(
        [(1, None, "new", at(1)), (3, "A", "x", at(1)), (3, "A", "new", at(2)), (4, None, "add", at(0))], schema
    )
    merged = I.merge_scd1(target, source, ["k", "c"], ["c"], "ts")
    assert sorted(r.v for r in merged.collect()) == ["add", "keep", "new", "new"]
    assert rows(I.merge_scd1(merged, source, ["k", "c"], ["c"], "ts")) == rows(merged)
    guarded = I.merge_scd1(target, source, ["k", "c"], ["c"], "ts", newer_only=True)
    assert sorted(r.v for r in guarded.collect()) == ["add", "keep", "new", "old"]
    plain = I.merge_scd1(target, source, ["k", "c"], order_by="ts")
    assert plain.filter("k = 1").count() == 2


def test_insert_only_and_self_derived_source(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    source = target.withColumn("v", F.lit("z")).union(spark.createDataFrame([(3, "c")], "k long, v string"))
    assert rows(I.merge_insert_only(target, source, ["k"])) == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(I.merge_scd1(target, source, ["k"])) == [(1, "z"), (2, "z"), (3, "c")]


def test_watermark(spark):
    df = spark.createDataFrame([(1, at(0, 3)), (2, at(1, 5)), (3, at(1, 1))], "id int, modified timestamp")
    kept = lambda mark: sorted(r.id for r in I.changed_since(df, "modified", mark).collect())
    assert kept(I.watermark(df.filter("id = 2"), "modified")) == [2, 3]
    assert kept(I.watermark(df.filter("id = 9"), "modified")) == [1, 2, 3]
    assert kept(I.watermark(None, "modified")) == kept(I.watermark(df, "load_ts")) == [1, 2, 3]


def test_scd2(spark):
    data = [(1, at(0), 5.0), (1, at(0), 5.0), (1, at(2), 6.0), (2, at(1), 1.0)]
    out = I.scd2_history(spark.createDataFrame(data, "film_id long, snapshot_ts timestamp, p double"), "film_id", "snapshot_ts")
    assert sorted((r.film_id, r.p, r.is_current) for r in out.collect()) == [(1, 5.0, False), (1, 6.0, True), (2, 1.0, True)]


def test_previous_in_time_is_lag(spark):
    rng = random.Random(1)
    stamps = {(rng.choice([1, 1, 1, 2, 3]), at(rng.randint(0, 9), rng.randint(0, 23))) for _ in range(200)}
    df = spark.createDataFrame([(k, t, rng.choice([None, 1, 2])) for k, t in sorted(stamps)], "k long, t timestamp, v int")
    lagged = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t"))).select("k", "t", "p")
    ours = I.previous_in_time(df, "k", "t", ["v"]).select("k", "t", F.col("prev_v").alias("p"))
    assert rows(ours) == rows(lagged)
    changes = I.scd2_changes(df, "k", "t", ["v"])
    first = Window.partitionBy("k").orderBy("t")
    expect = df.withColumn("p", F.lag("v").over(first)).withColumn("n", F.row_number().over(first)).filter("n = 1 or not p <=> v")
    assert changes.count() == expect.count()


def test_people_selection_defaults_missing_order(spark):
    cast = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "person_id long, cast_order int")
    crew = spark.createDataFrame([(4, "Director"), (5, "Gaffer")], "person_id long, job string")
    assert sorted(r.person_id for r in I.select_people(cast, crew, ["Director"]).collect()) == [1, 4]


def test_histories_keep_null_keys_and_times(spark):

    rows = [(None, 1, 5), (None, 2, 5), (1, None, 3), (2, None, 1), (2, 4, 1), (2, 9, 2)]
    df = spark.createDataFrame(rows, "k long, t long, v int").withColumn("ts", F.timestamp_seconds("t")).drop("t")
    history = I.scd2_history(df, "k", "ts").select("k", F.unix_timestamp("ts").alias("t"), "is_current").collect()
    assert {tuple(r) for r in history} == {(None, 1, False), (None, 2, True), (1, None, True), (2, None, False), (2, 4, False), (2, 9, True)}
    changes = I.scd2_changes(df, "k", "ts", ["v"]).select("k", F.unix_timestamp("ts").alias("t")).collect()
    assert {tuple(r) for r in changes} == {(None, 1), (1, None), (2, None), (2, 9)}


def test_salts_follow_the_counts(spark, monkeypatch):
    from marquee.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    many = spark.createDataFrame([(k, i) for k, n in ((1, 95), (2, 12), (None, 30), (3, 2)) for i in range(n)], "k long, i int")
    few = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k long, name string")
    hot = skew.hot_keys(many, "k", min_rows=10)
    assert hot.salts == {1: 10, None: 3, 2: 2}
    assert skew.salt_many(many, "k", hot).filter("k = 1").select("_salt").distinct().count() > 5
    joined = skew.skew_join(many, few, ["k"], "left", hot=hot)
    assert sorted(map(str, joined.select("k", "i", "name").collect())) == sorted(map(str, many.join(few, "k", "left").select("k", "i", "name").collect()))
    safe = skew.skew_join(many, few, ["k"], hot=hot, null_safe=True)
    assert safe.count() == many.count()


def test_landed_lines_are_read_split(spark, tmp_path):
    """A file of lines is read in several tasks; an object over several lines stays whole, junk is rejected."""
    (tmp_path / "lines.json").write_text("".join(f'{{"id": {i}}}\n' for i in range(20_000)) + '{"id": \n')
    (tmp_path / "object.json").write_text('\n{\n  "id":\n  -1\n}\n')
    (tmp_path / "junk.json").write_text('{"id"\n{"id": -2}\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        good = readers.json_tolerant(spark, str(tmp_path), "id long")
        assert good.select("id").distinct().count() == good.count() == 20_002 and good.agg(F.min("id")).first()[0] == -2
        assert rows(readers.json_rejected(spark, str(tmp_path), "id long").select("rejected")) == [('{"id"',), ('{"id": ',)]
        tasks = good.filter("id >= 0").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
