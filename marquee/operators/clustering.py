"""Positions of people in the film space, clusters and their labels."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ranking import rows_at
from .skew import skew_join, top_per_group

#: Centres in one expression of ``nearest_centroid``.
CENTRES = 500
CINEMATOGRAPHY = ["director of photography", "cinematographer"]


def person_film_roles(crew: DataFrame, people: DataFrame, films: DataFrame, min_votes: int = 100) -> DataFrame:
    """Directors and cinematographers with their sufficiently voted films."""
    job = F.lower("job")
    role = F.when(job == "director", "Director").when(job.isin(CINEMATOGRAPHY), "Cinematographer")
    wanted = crew.withColumn("role", role).filter("role is not null").select("person_id", "film_id", "role")
    voted = films.filter(F.col("vote_count") >= min_votes).select("film_id", "vote_average", "vote_count", "title")
    named = people.filter(F.col("name").isNotNull()).select("person_id", "name")
    return skew_join(skew_join(wanted, voted, ["film_id"]), named, ["person_id"])


def min_films(role: Column) -> Column:
    return F.when(role == "Director", 3).otherwise(2)


def person_positions(roles: DataFrame, film_xy: DataFrame) -> DataFrame:
    """Mean position of each person's films and the best rated one. Films without a
    position do not count; a film held under both roles counts twice, and such a person
    is listed as a director."""
    placed = skew_join(roles, film_xy, ["film_id"])
    return (
        placed.groupBy("person_id", "name")
        .agg(
            F.max("role").alias("role"),
            F.count("*").alias("film_count"),
            F.round(F.avg("x"), 5).alias("x"),
            F.round(F.avg("y"), 5).alias("y"),
            F.min(F.struct((-F.col("vote_average")).alias("_v"), "film_id", "title")).alias("_top"),
        )
        .filter(F.col("film_count") >= min_films(F.col("role")))
        .select(
            "person_id", "name", "role", "film_count", "x", "y",
            F.col("_top.film_id").alias("top_film_id"), F.col("_top.title").alias("top_film_title"),
        )
    )


def top_film_per_person(roles: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("vote_average")).alias("_v"), "film_id", "title"))
    return roles.groupBy("person_id").agg(best.alias("_top")).select(
        "person_id", F.col("_top.film_id").alias("top_film_id"), F.col("_top.title").alias("top_film_title")
    )


def mean_vectors(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Element-wise mean of a group's vectors, summed before the shuffle."""
    vectors = df.select(group, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    return vectors.groupBy(group).agg(F.count("*").alias("n"), vector_to_array(Summarizer.mean(F.col("_v"))).alias("mean_vector"))


def _spread_out(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Starting centres: each further one drawn by its squared distance to those before, then moved to the means of
    the sample's points around them."""
    centres = [sample[rng.integers(len(sample))]]
    near = ((sample - centres[0]) ** 2).sum(1)
    while len(centres) < k and near.max() > 0:
        centres.append(sample[rng.choice(len(sample), p=near / near.sum())])
        near = np.minimum(near, ((sample - centres[-1]) ** 2).sum(1))
    centres = np.array(centres)
    for _ in range(100):  # a good start saves passes over all rows
        near = ((sample[:, None, :] - centres) ** 2).sum(2).argmin(1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.stack([np.bincount(near, column, minlength=len(centres)) for column in sample.T], axis=1)
        moved = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
        if np.allclose(moved, centres, rtol=0, atol=1e-12):
            break
        centres = moved
    return centres


def kmeans(df: DataFrame, columns: list[str], k: int = 15, seed: int = 42, restarts: int = 10, out: str = "cluster", rounds: int = 200, sample: int = 4000) -> DataFrame:
    """k-means over numeric columns; the cheapest of several restarts assigns the clusters.

    All restarts advance together: each round is one pass that sums up the points of every (restart,
    cluster). A restart is done when its centres stay where they are. Starting centres come from at
    most ``sample`` rows, chosen by hash.
    """
    points = cut_lineage(df)
    vectors = points.select(*(F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)))
    some = vectors.distinct().orderBy(F.xxhash64(*vectors.columns), *vectors.columns).limit(sample).toPandas().to_numpy(float)
    if not len(some):
        return points.withColumn(out, F.lit(None).cast("int"))
    centres = {r: _spread_out(some, k, np.random.default_rng(seed + r)) for r in range(restarts)}
    done: dict[int, tuple] = {}
    size = float(np.abs(some).max()) + 1e-300

    names = vectors.columns

    def sums(of: dict[int, np.ndarray]):
        def work(batches):
            total: dict[tuple[int, int], np.ndarray] = {}
            for pdf in batches:
                x = pdf.to_numpy(float)
                for r, c in of.items():
                    d = ((x[:, None, :] - c) ** 2).sum(2)
                    near = d.argmin(1)
                    for i in np.unique(near):
                        mine = near == i
                        row = np.concatenate([[mine.sum(), d[mine, i].sum()], x[mine].sum(0)])
                        total[r, int(i)] = total.get((r, int(i)), 0) + row
            if total:
                rows = np.array([[*key, *row] for key, row in total.items()])
                yield pd.DataFrame(rows, columns=["r", "i", "n", "cost", *names]).astype({"r": "int32", "i": "int32"})

        kinds = ", ".join(f"{c} double" for c in ("n", "cost", *vectors.columns))
        found = vectors.mapInPandas(work, f"r int, i int, {kinds}")
        return found.groupBy("r", "i").agg(*(F.sum(c).alias(c) for c in ("n", "cost", *vectors.columns))).collect()  # restarts times clusters

    for turn in range(rounds):
        left = {r: c for r, c in centres.items() if r not in done}
        if not left:
            break
        moved = {r: c.copy() for r, c in left.items()}
        cost, used = dict.fromkeys(left, 0.0), dict.fromkeys(left, 0)
        for row in sums(left):
            moved[row["r"]][row["i"]] = [row[c] / row["n"] for c in vectors.columns]
            cost[row["r"]] += row["cost"]
            used[row["r"]] += 1
        for r, c in moved.items():
            if np.abs(c - left[r]).max() <= 1e-12 * size or turn + 1 == rounds:
                done[r] = (-used[r], cost[r], r)
            centres[r] = c
    best = centres[min(done.values())[2]]
    x = [F.col(c).cast("double") for c in columns]
    distance = lambda c: sum((v - F.lit(float(p))) * (v - F.lit(float(p))) for v, p in zip(x, c))
    options = [F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(best)]
    return points.withColumn(out, (F.least(*options) if len(options) > 1 else options[0])["i"])


def _closest(x: Column, y: Column, centres: list[tuple[float, float]]) -> Column:
    """Index of the closest centre, the first one on a tie. One expression in codegen; the
    centres are as few as the clusters."""
    distance = lambda cx, cy: (x - F.lit(cx)) * (x - F.lit(cx)) + (y - F.lit(cy)) * (y - F.lit(cy))
    options = [F.struct(distance(cx, cy).alias("d"), F.lit(i).alias("i")) for i, (cx, cy) in enumerate(centres)]
    return (F.least(*options) if len(options) > 1 else options[0])["i"]


def lloyd(df: DataFrame, key: str, x: str = "x", y: str = "y", k: int = 20, iterations: int = 40, out: str = "cluster") -> DataFrame:
    """Lloyd clustering from a fixed start: the centres begin at every ``n // k``-th point in
    key order, and a cluster that loses all its points keeps its centre. Each round sends
    ``k`` sums to the driver; rounds stop early once the centres no longer move."""
    points = cut_lineage(df)
    n = points.count()
    if n == 0:
        return points.withColumn(out, F.lit(None).cast("int"))
    at = [min(i * (n // k), n - 1) for i in range(k)]
    found = {r["position"]: (float(r[x]), float(r[y])) for r in rows_at(points, key, sorted(set(at))).collect()}
    centres = [found[p] for p in at]
    assigned, held = None, points.select(x, y).persist()
    for _ in range(iterations):
        assigned = centres
        moved = list(centres)
        sums = held.groupBy(_closest(F.col(x), F.col(y), centres).alias("c")).agg(F.avg(x).alias("cx"), F.avg(y).alias("cy"))
        for r in sums.collect():
            moved[r["c"]] = (r["cx"], r["cy"])
        if moved == centres:
            break
        centres = moved
    held.unpersist()
    return points.withColumn(out, _closest(F.col(x), F.col(y), assigned))


def centroid_spread(df: DataFrame, group: str, x: str = "x", y: str = "y") -> DataFrame:
    """Centre, size and root-mean-square distance to the centre of each group."""
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("n"),
        F.avg(x).alias("cx"),
        F.avg(y).alias("cy"),
        F.sqrt(F.var_pop(x) + F.var_pop(y)).alias("spread"),
    )


def nearest_centroid(df: DataFrame, centroids: DataFrame, group: str, x: str = "x", y: str = "y", out: str = "territory") -> DataFrame:
    """Closest group centre of each point, the first group on a tie. Centres are taken in
    blocks of at most ``CENTRES``, each one array in an expression; the best so far is carried
    along, so any number of groups will do."""
    few = centroids.filter(F.col(group).isNotNull()).select(group, "cx", "cy")
    n_blocks = max(1, -(-few.count() // CENTRES))
    kind = few.schema[group].dataType.simpleString()
    result = df.withColumn("_best", F.lit(None).cast(f"struct<d:double,g:{kind}>"))
    placed = cut_lineage(few.withColumn("_block", F.ntile(n_blocks).over(Window.orderBy(group)))) if n_blocks > 1 else few.withColumn("_block", F.lit(1))
    for block in range(1, n_blocks + 1):
        rows = placed.filter(F.col("_block") == block).collect()
        centres = F.array(*[F.struct(F.lit(float(r["cx"])).alias("cx"), F.lit(float(r["cy"])).alias("cy"), F.lit(r[group]).alias("g")) for r in rows])
        away = lambda c: (F.col(x) - c["cx"]) * (F.col(x) - c["cx"]) + (F.col(y) - c["cy"]) * (F.col(y) - c["cy"])
        nearest = F.array_min(F.transform(centres, lambda c: F.struct(away(c).alias("d"), c["g"].alias("g")))) if rows else F.col("_best")
        result = result.withColumn("_best", F.least(F.coalesce("_best", nearest), nearest))
        if block % 8 == 0:
            result = cut_lineage(result)
    return result.withColumn(out, F.col("_best.g")).drop("_best")


def cluster_labels(members: DataFrame, crew: DataFrame, film_genres: DataFrame, genres: DataFrame) -> DataFrame:
    """Label of each cluster: its two most frequent genres, or its three busiest people when
    none of its films has a genre. Genres are counted per person before clusters meet."""
    jobs = ["director", *CINEMATOGRAPHY]
    credits = crew.filter(F.lower("job").isin(jobs)).select("person_id", "film_id")
    in_cluster = skew_join(credits, members.select("person_id", "cluster"), ["person_id"])
    per_film = in_cluster.groupBy("film_id", "cluster").agg(F.count("*").alias("w"))
    tagged = skew_join(film_genres.select("film_id", "genre_id"), _as_lists(per_film), ["film_id"])
    expanded = tagged.select("genre_id", F.explode("clusters").alias("c")).groupBy("genre_id", "c.cluster").agg(F.sum("c.w").alias("n"))
    named = expanded.join(genres, "genre_id").groupBy("cluster", "genre_name").agg(F.sum("n").alias("n"))
    top = top_per_group(named, ["cluster"], [F.desc("n"), F.col("genre_name")], 2, "position")
    by_genre = top.groupBy("cluster").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "genre_name"))), lambda g: g["genre_name"]), " & ").alias("by_genre")
    )
    busiest = top_per_group(members, ["cluster"], [F.desc("film_count"), F.col("person_id")], 3, "position")
    by_name = busiest.groupBy("cluster").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "name"))), lambda p: p["name"]), ", ").alias("by_name")
    )
    return by_name.join(by_genre, "cluster", "left").select("cluster", F.coalesce("by_genre", "by_name").alias("cluster_label"))


def _as_lists(per_film: DataFrame) -> DataFrame:
    """Cluster weights of each film as one array; there are at most as many as clusters."""
    return per_film.groupBy("film_id").agg(F.collect_list(F.struct("cluster", "w")).alias("clusters"))


def node_table(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(F.broadcast(labels), "cluster", "left").select(
        "person_id", "name", "role", "film_count", "x", "y", "cluster", "cluster_label", "top_film_id", "top_film_title"
    )
