"""Resolution, ranks, neighbours, clusters and graphs against brute force."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import clustering as C
from marquee.operators import graph as G
from marquee.operators import neighbours as K
from marquee.operators import ranking, resolve as R, serving as V, skew


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_is_a_join(spark, how):
    many = spark.createDataFrame([(1, i) for i in range(60)] + [(2, 0), (None, 1), (4, 2)], "k int, v int")
    few = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n"), (3, "d")], "k int, w string")
    hot = skew.hot_keys(many, "k", min_rows=10)
    assert hot == [1]
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(skew.skew_join(many, few, ["k"], how, hot, salts=4)) == key(many.join(few, "k", how))
    safe = skew.skew_join(many, few, ["k"], how, [1, None], null_safe=True, salts=4)
    assert key(safe) == key(many.join(few.withColumnRenamed("k", "k2"), F.col("k").eqNullSafe(F.col("k2")), how).drop("k2"))


@pytest.mark.parametrize("buckets", [2, 7, 60])
def test_ranks_match_a_window(spark, buckets):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 0.0, 0.0, 0.0, rng.random() * 100]), rng.randint(0, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, v double, w int")
    ranked = ranking.add_ranks(df, {"rv": "v", "rw": "w"}, buckets=buckets)
    whole = lambda c: F.rank().over(Window.orderBy(F.col(c).desc_nulls_last()))
    expect = df.withColumn("rv", whole("v").cast("long")).withColumn("rw", whole("w").cast("long"))
    assert pairs(ranked, "id", "rv", "rw") == pairs(expect, "id", "rv", "rw")


def test_rows_at(spark):
    df = spark.createDataFrame([(i * 3,) for i in range(200)], "id int")
    assert pairs(ranking.rows_at(df, "id", [0, 17, 199], buckets=5), "position", "id") == [(0, 0), (17, 51), (199, 597)]


def brute_neighbours(points, k, digits=9):
    out = []
    for a, va in points.items():
        d = sorted((round(math.dist(va, vb), digits), b) for b, vb in points.items() if b != a)
        out += [(a, b, i + 1) for i, (_, b) in enumerate(d[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [8, 2048])
def test_nearest_is_exact_with_many_copies(spark, block):
    rng = random.Random(2)
    points = {i: (rng.random(), rng.random(), rng.random()) for i in range(90)}
    for i in range(90, 140):  # a third of the rows are one and the same vector
        points[i] = (0.5, 0.5, 0.5)
    df = spark.createDataFrame([(i, list(v)) for i, v in points.items()], "id long, v array<double>")
    assert pairs(K.nearest(df, "id", "v", 4, block=block), "id", "neighbour", "position") == brute_neighbours(points, 4)


def plane(n, seed=4):
    """Points of very different density: a third of them copies of one, a tight cluster, a wide one, some far away."""
    rng = np.random.default_rng(seed)
    xy = np.concatenate([np.full((n // 3, 2), 0.25), rng.normal(0.7, 1e-6, (n // 4, 2)), rng.random((n // 3, 2)), rng.normal(0, 50, (n // 12, 2))])
    return [(i, float(a), float(b)) for i, (a, b) in enumerate(xy)]


@pytest.mark.parametrize("need, block", [(12, 16), (256, 2048)])
def test_nearest_in_plane_is_exact(spark, need, block):
    rows = plane(420)
    df = spark.createDataFrame(rows, "id long, x double, y double").repartition(4)
    got = pairs(K.nearest_in_plane(df, "id", "x", "y", 5, need=need, block=block), "id", "neighbour", "position")
    assert got == brute_neighbours({i: (a, b) for i, a, b in rows}, 5)
    assert K.nearest_in_plane(df.limit(0), "id", "x", "y", 5).count() == 0
    assert K.nearest_in_plane(df.filter("id < 3"), "id", "x", "y", 5).count() == 6


def test_points_look_into_nine_cells_whatever_their_number(spark):
    looked = []
    for n in (1200, 4800):
        df = spark.createDataFrame([(i, [a, b]) for i, a, b in plane(n)[n // 3 :]], "vid long, vec array<double>")
        grid = K.Grid(df)
        placed = df.select("vid", "vec", grid.place(0).alias("fx"), grid.place(1).alias("fy"))
        asked = K._levels(placed, grid, 64, 256).selectExpr("vid", "level", "shiftright(fx, 30 - level) cx", "shiftright(fy, 30 - level) cy")
        assert asked.count() == df.count()
        cells = K.grid_candidates(placed, asked).groupBy("level", "cx", "cy").count()
        looked.append(asked.join(cells, ["level", "cx", "cy"]).selectExpr("avg(count)").first()[0])
    assert max(looked) < 64 * 10 and looked[1] < 1.5 * looked[0]


def test_lists_find_the_nearest_and_stay_of_one_size(spark):
    rng = np.random.default_rng(3)
    candidates = []
    for n in (1000, 4000):
        centre = rng.normal(size=(n // 25, 16))
        vectors = centre[rng.integers(len(centre), size=n)] + rng.normal(size=(n, 16)) * 0.2
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, v array<double>").repartition(4)
        own, look = K.inverted_lists(K._points(df.select("id", K._unit(F.col("v")).alias("vec")).withColumnRenamed("id", "_id"), 5), 64, 16, 8)
        sizes = own.groupBy("list").count()
        assert own.count() == n and sizes.agg(F.max("count")).first()[0] <= 64
        assert look.groupBy("vid").count().agg(F.max("count")).first()[0] <= 8
        candidates.append(look.join(sizes, "list").groupBy("vid").agg(F.sum("count").alias("n")).agg(F.avg("n")).first()[0])
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        asked = range(0, n, 50)
        want = {(i, j) for i in asked for j in np.argsort(-(unit[i] @ unit.T))[:6].tolist() if j != i}
        got = {(r.id, r.neighbour) for r in K.nearest_by_lists(df, "id", "v", 5, size=64, fan=16, probes=8).filter("id % 50 = 0").collect()}
        assert len(want & got) >= 0.9 * len(want)
    print("candidates of a vector:", candidates)
    assert candidates[1] < 1.3 * candidates[0]


def test_nearest_with_too_few_rows(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.6, 0.8])], "id long, v array<double>")
    got = pairs(K.nearest(df, "id", "v", 8, "cosine"), "id", "neighbour", "value")
    assert got == [(1, 2, 0.0), (1, 3, 0.8), (2, 1, 0.0), (2, 3, 0.6), (3, 1, 0.8), (3, 2, 0.6)]
    assert K.nearest(df.limit(0), "id", "v", 2).count() == 0


def test_symmetric_edges(spark):
    df = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.7), (1, 3, 0.4)], "src long, dst long, sim double")
    both = K.symmetric_edges(df)
    assert pairs(both, "src", "dst", "sim") == [(1, 2, 0.7), (1, 3, 0.4), (2, 1, 0.7), (3, 1, 0.4)]
    assert pairs(K.symmetric_edges(both), "src", "dst", "sim") == pairs(both, "src", "dst", "sim")


def test_kmeans_and_lloyd(spark):
    rng = random.Random(4)
    centres = [(0, 0), (5, 5), (0, 9)]
    rows = [(i, x + rng.random(), y + rng.random()) for i, (x, y) in enumerate(centres * 20)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    groups = {}
    for r in C.kmeans(df, ["x", "y"], k=3, restarts=2).collect():
        groups.setdefault(r.cluster, set()).add(r.id % 3)
    assert len(groups) == 3 and all(len(g) == 1 for g in groups.values())

    k, now = 4, None
    at = [rows[min(i * (len(rows) // k), len(rows) - 1)][1:] for i in range(k)]
    for _ in range(10):
        now = [min(range(k), key=lambda i: ((x - at[i][0]) ** 2 + (y - at[i][1]) ** 2, i)) for _, x, y in rows]
        for i in range(k):
            mine = [rows[j] for j, c in enumerate(now) if c == i]
            if mine:
                at[i] = (sum(m[1] for m in mine) / len(mine), sum(m[2] for m in mine) / len(mine))
    assert [c for _, c in pairs(C.lloyd(df, "id", k=k, iterations=10), "id", "cluster")] == now


def test_cluster_label_falls_back_to_names(spark):
    members = spark.createDataFrame([(1, "Ann", 0, 5), (2, "Bob", 1, 3), (3, "Cy", 1, 9)], "person_id long, name string, cluster int, film_count long")
    crew = spark.createDataFrame([(1, 7, "Director")], "person_id long, film_id long, job string")
    genres = spark.createDataFrame([(1, "Drama"), (2, "War")], "genre_id int, genre_name string")
    tagged = spark.createDataFrame([(7, 1), (7, 2)], "film_id long, genre_id int")
    labels = C.cluster_labels(members, crew, tagged, genres)
    assert pairs(labels, "cluster", "cluster_label") == [(0, "Drama & War"), (1, "Cy, Bob")]


# ---- graph -------------------------------------------------------------------------


def test_shortest_hops_and_path(spark):
    rng = random.Random(8)
    credits = {(rng.randint(0, 40), 100 + rng.randint(0, 30)) for _ in range(70)} | {(99, 999)}
    df = spark.createDataFrame(sorted(credits), "film_id long, person_id long")
    start = min(f for f, _ in credits)
    hops, level = {start: 0}, {start}
    while level:
        people = {p for f, p in credits if f in level}
        level = {f for f, p in credits if p in people} - set(hops)
        hops.update({f: max(hops.values()) + 1 for f in level})
    reached = G.shortest_hops(df, spark.createDataFrame([(start,)], "film_id long"))
    assert dict(pairs(reached, "film_id", "hops")) == hops and 99 not in hops
    far = max(hops, key=hops.get)
    asked = spark.createDataFrame([(start, far), (start, start), (start, 99), (far, start)], "start_id long, target_id long")
    steps = [r.asDict() for r in G.connection_paths(reached, asked).collect()]
    assert {(r["start_id"], r["target_id"]) for r in steps} == {(start, far), (start, start)}
    path = sorted((r for r in steps if r["target_id"] == far), key=lambda r: r["step"])
    assert len(path) == hops[far] + 1 and path[0]["film_id"] == start
    for before, step in itertools.pairwise(path):
        assert (before["film_id"], step["via_person"]) in credits and (step["film_id"], step["via_person"]) in credits


def test_paths_longer_than_six_steps(spark):
    chain = [(film, 100 + film + d) for film in range(13) for d in (0, 1)]
    df = spark.createDataFrame(chain, "film_id long, person_id long")
    reached = G.shortest_hops(df, spark.createDataFrame([(0,)], "film_id long"))
    assert dict(pairs(reached, "film_id", "hops")) == {f: f for f in range(13)}
    steps = G.connection_paths(reached, spark.createDataFrame([(0, 12)], "start_id long, target_id long")).collect()
    assert sorted((r.step, r.film_id, r.via_person) for r in steps) == [(i, i, 100 + i if i else None) for i in range(13)]
    assert G.shortest_hops(df, spark.createDataFrame([(0,)], "film_id long"), max_films=3).count() == 4


def test_recommend_matches_all_pairs(spark):
    rng = random.Random(6)
    rel = {(rng.randint(0, 30), f"r{rng.choice([0, 0, 0, 1, 2, 3, 4, 5])}") for _ in range(90)}
    votes = {f: rng.randint(0, 5) / 2 for f in range(31)}
    got = G.recommend(spark.createDataFrame(sorted(rel), "film_id long, reason string"), spark.createDataFrame(list(votes.items()), "film_id long, vote_average double"), 3)
    expect = []
    for f in {f for f, _ in rel}:
        mine = {r for g, r in rel if g == f}
        others = {g: sorted(mine & {r for h, r in rel if h == g}) for g in votes if g != f}
        best = sorted((g for g in others if others[g]), key=lambda g: (-votes[g], g))[:3]
        expect += [(f, g, len(others[g]), others[g]) for g in best]
    assert pairs(got, "film_id", "recommended_id", "shared", "reasons") == sorted(expect)


def best_by_all_pairs(rel, votes, k):
    by = {f: {r for g, r in rel if g == f and r is not None} for f, _ in rel}
    out = []
    for f in (f for f in by if f is not None):
        near = sorted((g for g in votes if g in by and g != f and by[f] & by[g]), key=lambda g: (votes[g] is None, -(votes[g] or 0), g))
        out += [(f, g, votes[g], n, sorted(by[f] & by[g])) for n, g in enumerate(near[:k], 1)]
    return sorted(out)


def test_recommended_films_bring_their_reasons(spark, monkeypatch):
    """What offered a film is all it shares, so nothing is stored and looked up after the choice. Ids and votes travel
    as one number where they fit: here large ids and votes that are null, negative or no short decimals are among them."""
    stored, cut = [], G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: cut(df) if stored.append(df.columns) is None else None)
    rng = random.Random(16)
    ids = [*range(25), 1 << 31, (1 << 40) + 3]
    odd = [None, -7.25, 0.1 + 0.2, 1e300, 75462.67, 8.125]
    rel = [(rng.choice(ids), f"r{rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, 7])}") for _ in range(90)] + [(None, "r1"), (3, None), (99, "r2")]
    votes = {f: odd[f % 6] if f in (2, 6, 9, 11, 19) else rng.randint(0, 40) / 8 for f in ids}
    films = spark.createDataFrame([*votes.items(), (None, 1.0), (None, 2.0)], "film_id long, vote_average double")
    got = G.recommend(spark.createDataFrame(rel, "film_id long, reason string"), films, 3, 2)
    found = sorted((r.film_id, r.recommended_id, r.vote_average, r.position, r.shared, r.reasons) for r in got.collect())
    assert found == [(f, g, v, n, len(why), why[:2]) for f, g, v, n, why in best_by_all_pairs(rel, votes, 3)]
    assert len(stored) == 1
    lists = spark.createDataFrame([([(1, 7.253), (5, -75462.67)],), ([(1, 0.1 + 0.2)],), ([(1 << 31, 1.0)],), ([(1, None)],)], "l array<struct<film_id:long,vote_average:double>>")
    there = [(r.p, r.back) for r in lists.select(G._packed(F.col("l")).alias("p")).select("p", F.transform("p", G._unpacked).alias("back")).collect()]
    assert there[0][1] == [(1, 7.253), (5, -75462.67)] and [p for p, _ in there[1:]] == [None] * 3


@pytest.mark.parametrize("most", [1, 100])
def test_reasons_of_recommended_films_are_not_looked_up_again(spark, most):
    """Only of those pairs whose list was cut, which there are where a film has more reasons than are listed."""
    rng = random.Random(17)
    rel = [(rng.randint(0, 20), f"r{rng.randint(0, 5)}") for _ in range(70)]
    votes = {f: rng.randint(0, 40) / 8 for f in range(21)}
    relations = spark.createDataFrame(rel, "film_id long, reason string")
    chosen = G.recommend(relations, spark.createDataFrame(list(votes.items()), "film_id long, vote_average double"), 3, most)
    got = G.recommendation_reasons(relations, chosen)
    assert pairs(got, "film_id", "recommended_id", "reason") == sorted((f, g, r) for f, g, _, _, why in best_by_all_pairs(rel, votes, 3) for r in why)
    assert ("bit_or" in got._jdf.queryExecution().executedPlan().toString()) == (most == 1)


@pytest.mark.parametrize("cells", [7, 100, 4_000_000])
def test_rows_are_sent_to_few_blocks(spark, monkeypatch, cells):
    """Of 170 points in blocks of 2 each is sent to 11 blocks of 16, not to 85; the values of a block needn't be held at once."""
    monkeypatch.setattr(K, "CELLS", cells)
    rng = random.Random(12)
    points = {i: (rng.random(), rng.random()) for i in range(170)}
    df = spark.createDataFrame([(i, list(p)) for i, p in points.items()], "id long, v array<double>")
    assert pairs(K.nearest(df, "id", "v", 4, block=2), "id", "neighbour", "position") == brute_neighbours(points, 4)
    assert [K._blocks(n, 2) for n in (0, 1, 5, 100, 170)] == [1, 1, 3, 8, 11]


def test_reasons_of_pairs_are_looked_up_by_bits_first(spark):
    """Films of one and of very many reasons, whose bits are all set."""
    rng = random.Random(8)
    rel = sorted({(f, f"r{rng.randint(0, 400)}") for f in range(12) for _ in range(1 if f < 6 else 300)})
    asked = [(f, g) for f in range(12) for g in range(12) if f != g]
    got = G.recommendation_reasons(spark.createDataFrame(rel, "film_id long, reason string"), spark.createDataFrame(asked, "film_id long, recommended_id long"))
    assert pairs(got, "film_id", "recommended_id", "reason") == sorted((f, g, r) for f, g in asked for h, r in rel if h == f and (g, r) in set(rel))
    assert "bit_or" in got._jdf.queryExecution().executedPlan().toString()


def test_lists_unfold_in_parts(spark, monkeypatch):
    """All films share one thing: its list unfolds over many tasks, none of which takes over ``UNFOLDED`` rows by much."""
    monkeypatch.setattr(skew, "UNFOLDED", 100)
    films = [(i, f"t{i}", f"f{i}", 500 + i, 2000 + i % 7) for i in range(60)]
    movies = spark.createDataFrame(films, "film_id long, imdb_id string, title string, vote_count int, year int")
    tagged = spark.createDataFrame([(i, "g") for i in range(60)] + [(i, "h") for i in range(30)], "film_id long, genre_id string")
    related = V.related_by_genre(movies, tagged, 5)
    assert pairs(related, "center_id", "film_id", "position") == sorted((c, f, n) for c in range(60) for n, f in enumerate([f for f in range(59, 50, -1) if f != c][:5], 1))
    catalog = movies.select(F.col("imdb_id").alias("tconst"), F.col("film_id").alias("id"), "title", "year")
    based = spark.createDataFrame([(f"t{i}", "s", "label") for i in range(60)], "imdb_id string, source_wikidata_id string, source_label string")
    adapted = V.co_adaptations(based, catalog, 5)
    order = sorted(range(60), key=lambda f: (2000 + f % 7, f))
    assert pairs(adapted, "center_id", "film_id", "position") == sorted((c, f, n) for c in range(60) for n, f in enumerate([f for f in order if f != c][:5], 1))
    for found, least in ((related, 5), (adapted, 4)):
        assert found.rdd.getNumPartitions() >= least


def ego(spark):
    films = spark.createDataFrame([(1, "tt1", "One", "2001-01-01", 8.0, 900), (2, "tt2", "Two", "2002-01-01", 7.0, 800), (3, "tt3", "Lone", None, 6.0, 700)],
                                  "film_id long, imdb_id string, title string, release_date string, vote_average double, vote_count int")
    people = spark.createDataFrame([(10, "Ann"), (11, "Bob")], "person_id long, name string")
    crew = spark.createDataFrame([(1, 10, "Director"), (1, 10, "Editor"), (2, 10, "Editor"), (3, 11, "Writer")], "film_id long, person_id long, job string")
    cast = spark.createDataFrame([(1, 10, 0, "Self"), (3, 11, 1, "Him")], "film_id long, person_id long, cast_order int, character string")
    genres = spark.createDataFrame([(5, "Drama")], "genre_id int, genre_name string")
    tagged = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "film_id long, genre_id int")
    bridge = spark.createDataFrame([("tt1", 1), ("tt2", 2)], "tconst string, film_id long")
    catalog = films.select(F.col("film_id").alias("id"), F.col("imdb_id").alias("tconst"), "title", F.year(F.col("release_date").cast("date")).alias("year"))
    based = spark.createDataFrame([("tt1", "S", "Novel"), ("tt2", "S", "Novel"), ("tt2", "S", "Novel")], "imdb_id string, source_wikidata_id string, source_label string")
    links = V.crew_connections(crew, people, films, bridge)
    parts = G.EgoParts(films, links, V.co_adaptations(based, catalog), tagged, genres, V.related_by_genre(films, tagged), cast, crew, people)
    return films, crew, cast, parts, links


def test_ego_graph_kinds_and_fallback(spark):
    films, crew, cast, parts, links = ego(spark)
    assert pairs(links, "center_id", "person_id", "role", "film_id") == [(1, 10, "Director", 2), (2, 10, "Editor", 1)]
    nodes = {(r.center_id, r.node_id): r.kind for r in G.ego_nodes(parts).collect()}
    assert nodes[1, "film_1"] == "center" and nodes[1, "person_10"] == "crew_bridge" and nodes[1, "crew_film_2"] == "crew_film"
    assert nodes[1, "source_S"] == "source" and nodes[1, "source_film_2"] == "source_film" and (1, "genre_5") not in nodes
    assert nodes[3, "genre_5"] == "genre" and nodes[3, "film_1"] == "related" and nodes[3, "person_11"] == "person"
    edges = pairs(G.ego_edges(parts).filter("center_id = 3"), "source", "target")
    assert ("genre_5", "film_1") in edges and ("film_3", "genre_5") in edges
    grown = G.ego_expand(G.ego_nodes(parts), V.filmography(crew.withColumn("job", F.lit("Director")), cast, films))
    assert ("pfilm_2", 1) in pairs(grown.filter("center_id = 1"), "node_id", "people")


def test_ego_graphs_unfold_in_parts(spark, monkeypatch):
    """Three films are dealt over as many tasks as their graphs need, however few bytes they are."""
    monkeypatch.setattr(skew, "UNFOLDED", 50)
    parts = ego(spark)[3]
    for found in (G.ego_nodes(parts), G.ego_edges(parts)):
        assert found.rdd.getNumPartitions() == 3 * G.AROUND // 50


def test_expanded_films_match_all_rows(spark, monkeypatch):
    """Graphs go to films as short lists: a person of many graphs, a film that most graphs reach, films of
    several titles or none, graphs without an id, films that a graph holds already."""
    stored, cut = [], G.cut_lineage
    monkeypatch.setattr(G, "cut_lineage", lambda df: cut(df) if stored.append(df.columns) is None else None)
    monkeypatch.setattr(skew, "UNFOLDED", 20)
    monkeypatch.setattr(G, "LISTED", 4)
    rng = random.Random(11)
    around = {(c, p) for c in [None, *range(40)] for p in range(12) if p == 0 or rng.random() < 0.2}
    work = {(p, f) for p in range(14) for f in range(9) if f == 0 or rng.random() < 0.3}
    titles = {0: ["A"], 1: ["B", "C"], 2: [None], 3: [None, "D"]}
    rows = [(p, f, t, None if f == 4 else f"20{10 + f}-01-01") for p, f in sorted(work) for t in titles.get(f, [f"T{f}"]) if t != "B" or p % 2]
    made = lambda several: [r for r in rows if several or (len(titles.get(r[1], [1])) == 1)]
    nodes = [(c, f"person_{p}", "person", "x" * 50, None) for c, p in around] + [(c, f"film_{c}", "center", "x", None) for c in range(40)]
    for several, held in ((True, {(3, 0), (None, 0), (5, 7)}), (False, set())):
        expect = {}
        for p, f, t, d in made(several):
            for c in (c for c, q in around if q == p and ((c, f) not in held or c is None)):
                label, n = expect.get((c, f), (None, 0))
                new = t and f"{t} ({d[:4] if d else ''})"
                expect[c, f] = (min(x for x in (label, new) if x) if label or new else None, n + 1)
        df = spark.createDataFrame(nodes + [(c, f"pfilm_{f}", "person_film", "x", None) for c, f in held], "center_id long, node_id string, kind string, label string, role string")
        got = G.ego_expand(df, spark.createDataFrame(made(several) * 2, "person_id long, film_id long, title string, release_date string"))
        found = {(r.center_id, r.node_id): (r.label, r.people) for r in got.collect()}
        assert got.columns == ["center_id", "node_id", "label", "people"] and len(found) == got.count()
        assert found == {(c, f"pfilm_{f}"): x for (c, f), x in expect.items()}
    met = sum(q == p for p, _, _, _ in made(False) for _, q in around)
    assert got.rdd.getNumPartitions() == -(-met // 20)  # one shuffle, whose parts are given by the rows that lists unfold to
    assert stored and all("kind" not in columns and "role" not in columns for columns in stored)


# ---- people ------------------------------------------------------------------------


def names_fixture(spark):
    rng = random.Random(9)
    first, last = ["anna", "hannah", "marianne", "li", "jo"], ["weatherby", "weatherbee", "li", "featherstone", "oldenburgh"]
    a = [(f"tt{rng.randint(0, 3)}", i, f"{rng.choice(first)} {rng.choice(last)}") for i in range(60)]
    b = []
    for i in range(60):
        name = f"{rng.choice(first)} {rng.choice(last)}"
        at = rng.randrange(len(name))
        b.append((f"tt{rng.randint(0, 3)}", f"nm{i:02d}", name[:at] + rng.choice(["", "x", name[at]]) + name[at + 1 :]))
    return spark.createDataFrame(a, "tconst string, person_id long, name_a string"), spark.createDataFrame(b, "tconst string, nconst string, name_b string")


def test_crowded_films_give_the_same_pairs(spark):
    credits, principals = names_fixture(spark)
    columns = ("tconst", "name_a", "name_b")
    plain = pairs(R.candidate_names(credits, principals), *columns)
    assert plain and plain == pairs(R.candidate_names(credits, principals, block_pairs=0), *columns)


def test_fuzzy_links_are_the_best_of_all_pairs(spark):
    from marquee.functions.names import _similarity

    credits, principals = names_fixture(spark)
    best = {}
    for a in credits.collect():
        for b in principals.collect():
            if a.tconst == b.tconst and (s := _similarity(a.name_a, b.name_b)) >= 90:
                best[a.person_id] = min(best.get(a.person_id, (0, "~")), (-s, b.nconst))
    got = R.fuzzy_links(credits, principals)
    assert pairs(got, "tmdb_person_id", "nconst") == sorted((p, n) for p, (_, n) in best.items())


@pytest.mark.parametrize("side, block_pairs", [(7, 12), (7, 0), (60, 100)])
def test_crowded_films_take_the_way_of_fewer_rows(spark, side, block_pairs):
    from marquee.functions.names import _similarity

    rng = random.Random(side)
    names = ["".join(rng.choice("abcdefgh ") for _ in range(12)).strip() + "z" for _ in range(side)]
    worn = [n[:3] + "x" + n[4:] for n in names]
    a = [(f, i, n) for f in ("tt1", "tt2") for i, n in enumerate(names)] + [("tt1", 900, names[0]), ("tt3", 901, "alone")]
    b = [(f, f"nm{i:02d}", n) for f in ("tt1", "tt2") for i, n in enumerate(worn)] + [("tt2", "nm00a", worn[0]), ("tt4", "nm99", "alone")]
    credits = spark.createDataFrame(a, "tconst string, person_id long, name_a string")
    principals = spark.createDataFrame(b, "tconst string, nconst string, name_b string")
    ways = {(r.tconst, r._by_pieces) for r in R.crowded_films(credits, principals, 90.0, block_pairs).collect()}
    assert ways == {("tt1", side == 60), ("tt2", side == 60)}
    columns = ("tconst", "name_a", "name_b")
    plain = pairs(R.candidate_names(credits, principals), *columns)
    assert len(plain) >= 2 * side and plain == pairs(R.candidate_names(credits, principals, block_pairs=block_pairs), *columns)
    best = {}
    for f, p, n in a:
        for g, k, m in b:
            if f == g and (s := _similarity(n, m)) >= 90:
                best[p] = min(best.get(p, (0, "~")), (-s, k))
    for limit in (10_000, block_pairs):
        got = R.fuzzy_links(credits, principals, block_pairs=limit)
        assert pairs(got, "tmdb_person_id", "nconst") == sorted((p, n) for p, (_, n) in best.items())


def test_people_who_meet_on_many_films_are_one_pair(spark):
    films = [f"tt{i}" for i in range(20)]
    credits = spark.createDataFrame([(f, p, "ann lee") for f in films for p in (1, 2)], "tconst string, person_id long, name_a string")
    principals = spark.createDataFrame([(f, "nm1", "anne lee") for f in films], "tconst string, nconst string, name_b string")
    for block_pairs in (0, 1, 10_000):
        met = R._named_pairs(credits, principals, 90.0, block_pairs)
        assert pairs(met, *met.columns) == [(1, "nm1", "ann lee", "anne lee"), (2, "nm1", "ann lee", "anne lee")]


def test_conflicts_and_scope(spark):
    direct = spark.createDataFrame([(1, "nm1", "imdb_id_direct", 1.0), (5, "nm5", "imdb_id_direct", 1.0), (6, "nm5", "imdb_id_direct", 1.0)], "tmdb_person_id long, nconst string, method string, confidence double")
    fuzzy = spark.createDataFrame([(2, "nm1", 95.0), (3, "nm3", 92.0), (4, "nm3", 99.0)], "tmdb_person_id long, nconst string, score double")
    settled = R.settle_conflicts(direct, fuzzy)
    assert pairs(settled, "nconst", "tmdb_person_id") == [("nm1", 1), ("nm3", 4), ("nm5", 5)]
    crew = spark.createDataFrame([(2, 7), (4, 7), (9, 8)], "person_id long, film_id long")
    cast = spark.createDataFrame([(3, 7)], "person_id long, film_id long")
    principals = spark.createDataFrame([("tt7", "nm3"), ("tt7", "nm8"), ("tt8", "nm9")], "tconst string, nconst string")
    bridge = spark.createDataFrame([("tt7", 7)], "tconst string, film_id long")
    full = R.complete_scope(settled, crew, cast, principals, bridge)
    single = pairs(full.filter("source != 'both'").select(F.coalesce(F.col("tmdb_person_id").cast("string"), "nconst").alias("who"), "source"), "who", "source")
    assert single == [("2", "tmdb_only"), ("3", "tmdb_only"), ("nm8", "imdb_only")]


# ---- plans -------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    from marquee.operators.dedup import latest_per_key

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(latest_per_key(events.filter("event_type = 'click'").select("user_id", "ts", "event_type"), ["user_id"], "ts", []))
    assert plan.count("WindowGroupLimit") == 2  # trimmed before and after the shuffle
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    from marquee.operators.incremental import merge_scd1

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderstatus")
    merged = plan_of(merge_scd1(orders, orders, ["o_orderkey", "o_orderstatus"], ["o_orderstatus"]))
    assert "NestedLoop" not in merged and "LeftAnti" in merged


def _unbroadcast(spark, plan):
    """The physical plan as text, as it is for tables too large to broadcast."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_filmography_streams_credits_once(spark):
    crew = spark.createDataFrame([(1, 7, "Director"), (1, 7, "Director"), (1, 7, "Writer"), (2, 7, "Editor"), (None, 7, "Writer"), (2, None, "Writer")], "film_id int, person_id int, job string")
    cast = spark.createDataFrame([(1, 7, "Role"), (1, 7, "Role"), (2, 7, None), (2, 7, None), (3, 7, "Role")], "film_id int, person_id int, character string")
    films = spark.createDataFrame([(1, "one", "2001-01-01", 300), (2, "two", None, 300), (3, "three", "2002-01-01", 10)], "film_id int, title string, release_date string, vote_count int")
    found = {tuple(r) for r in V.filmography(crew, cast, films).collect()}
    assert found == {
        (7, 1, 1, "one", "2001-01-01", "Director", None), (7, 2, 1, "one", "2001-01-01", "Writer", None), (7, 3, 1, "one", "2001-01-01", None, "Role"),
        (7, 4, 2, "two", None, None, None), (None, 1, 2, "two", None, "Writer", None),
    }
    # Credits are neither sorted for the join nor freed of repeats a second time.
    plan = _unbroadcast(spark, lambda: V.filmography(crew.distinct(), cast.distinct(), films))
    assert "SortMergeJoin" not in plan and plan.count("HashAggregate") == 4


def test_relations_of_films_are_neither_sorted_nor_sent_twice(spark):
    relations = spark.createDataFrame([("tt1", "Q1", "b"), ("tt1", "Q1", "b"), ("tt1", "Q2", "a"), ("tt1", "Q3", None), ("tt9", "Q1", "b"), (None, "Q1", "b")], "imdb_id string, id string, label string")
    bridge = spark.createDataFrame([("tt1", 1), ("tt1", 2), ("tt2", 3), (None, 4)], "tconst string, film_id int")
    labels = lambda: R.label_sets(R.relation_bridge(relations, bridge, "id", "label"), "label", "labels")
    assert {(r.film_id, tuple(r.labels)) for r in labels().collect()} == {(1, ("a", "b")), (2, ("a", "b"))}
    plan = _unbroadcast(spark, labels)
    # Each side to its key once, then one row a film and task.
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 3
