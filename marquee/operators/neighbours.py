"""Nearest neighbours of vectors: exact in blocks, exact in the plane over grid cells, and over inverted lists.

Identical vectors, however many, are one point until the end: a point carries as many of its ids as any answer
can use.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import skew_join, top_per_group

BLOCK = 2048
#: How much larger blocks get where all are compared with all: every row is sent to each block of the other side.
WIDE = 8
#: Values a task holds at a time.
CELLS = 4_000_000
#: Finest level of the grid, whose cells are the plane's extent over two to that power.
FINEST = 30
#: Cuts of a list at most.
DEEPEST = 30
NEAR = "vid bigint, near bigint, d double"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by differences, so equal inputs give equal results anywhere."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.sqrt(((a[i : i + step, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def _best(q: pd.DataFrame, c: pd.DataFrame, wanted: int, cosine: bool, digits: int) -> pd.DataFrame:
    """The ``wanted`` nearest of ``c`` for each of ``q`` (both ``vid, vec``); cosines count negative."""
    if len(q) == 0 or len(c) == 0:
        return pd.DataFrame({"vid": [], "near": [], "d": []}).astype({"vid": "int64", "near": "int64", "d": "float64"})
    left, right = _matrix(q["vec"]), _matrix(c["vec"])
    ids, keep = c["vid"].to_numpy(), min(wanted, len(c))
    step = max(1, CELLS // len(ids))  # the values of some rows at a time
    parts = [_nearest_of(left[i : i + step], right, ids, keep, cosine, digits) for i in range(0, len(left), step)]
    rows = np.concatenate([r + i * step for i, (r, _, _) in enumerate(parts)])
    return pd.DataFrame({"vid": q["vid"].to_numpy()[rows], "near": np.concatenate([n for _, n, _ in parts]), "d": np.concatenate([d for _, _, d in parts])})


def _nearest_of(left: np.ndarray, right: np.ndarray, ids: np.ndarray, keep: int, cosine: bool, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the row of ``left``, id of the row of ``right`` and value of the ``keep`` nearest."""
    d = np.round(-(left @ right.T) if cosine else _distances(left, right), digits) + 0.0
    if keep < len(ids):  # those that reach the last place, ties included
        last = np.partition(d, keep - 1, axis=1)[:, keep - 1]
        rows, columns = np.nonzero(d <= last[:, None])
    else:
        rows, columns = np.divmod(np.arange(d.size), len(ids))
    order = np.lexsort((ids[columns], d[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    rows, columns = rows[place < keep], columns[place < keep]
    return rows, ids[columns], d[rows, columns]


# ---- one point per distinct vector ------------------------------------------------------


def _unit(vector: Column) -> Column:
    return F.transform(vector, lambda x: x / F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, y: s + y * y)))


def _points(rows: DataFrame, k: int) -> DataFrame:
    """``vid, vec, ids`` of the distinct vectors of ``_id, vec``."""
    numbered = top_per_group(rows, ["vec"], [F.col("_id")], k + 1)
    ids = F.sort_array(F.collect_list("_id")).alias("ids")
    return cut_lineage(numbered.groupBy("vec").agg(ids).select(F.col("ids")[0].alias("vid"), "vec", "ids"))


def _answers(rows: DataFrame, points: DataFrame, near: DataFrame, key: str, k: int, cosine: bool) -> DataFrame:
    """What the points near each point mean for the rows: copies are neighbours of each other."""
    listed = near.join(points.select(F.col("vid").alias("near"), "ids"), "near").select("vid", "d", F.explode("ids").alias("other"))
    best = top_per_group(listed, ["vid"], [F.col("d"), F.col("other")], k + 1, "_position")
    lists = best.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("_position", "other", "d"))).alias("near"))
    mine = skew_join(rows, points.select("vid", "vec"), ["vec"]).select("_id", "vid")
    others = F.slice(F.filter("near", lambda n: n["other"] != F.col("_id")), 1, k)
    sign = F.lit(-1.0) if cosine else F.lit(1.0)
    return (
        skew_join(mine, lists, ["vid"])
        .select(F.col("_id").alias(key), F.posexplode(others).alias("_p", "n"))
        .select(key, F.col("n.other").alias("neighbour"), (sign * F.col("n.d")).alias("value"), (F.col("_p") + 1).alias("position"))
    )


def _search(df: DataFrame, key: str, vector: Column, k: int, cosine: bool, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    rows = df.select(F.col(key).alias("_id"), (_unit(vector) if cosine else vector).alias("vec"))
    points = _points(rows, k)
    return _answers(rows, points, find(points), key, k, cosine)


def _parts(count: Column | str, block: int) -> Column:
    return F.ceil(F.col(count) / block).cast("int")


def _dealt(parts: Column | str) -> Column:
    return F.pmod(F.xxhash64("vid"), F.col(parts)).cast("int")


def _every(parts: Column | str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


# ---- exact, all with all ----------------------------------------------------------------


def _blocks(count: int, block: int) -> int:
    """Blocks of ``WIDE`` times ``block`` rows, or of ``block`` as long as these are no more than ``WIDE``."""
    return max(1, min(WIDE, math.ceil(count / block)), math.ceil(count / (WIDE * block)))


def nearest(df: DataFrame, key: str, vector: str, k: int, metric: str = "euclidean", digits: int = 9, block: int = BLOCK) -> DataFrame:
    """``k`` nearest other rows of each row: (``key``, neighbour, value, position).

    ``value`` is the distance, or the similarity when ``metric`` is cosine. Values are
    compared after rounding to ``digits``; ties go to the smaller key. Keys are bigints.
    Blocks of rows are compared with each other, so the work grows with the square of the
    rows; ``nearest_in_plane`` and ``nearest_by_lists`` don't. Blocks grow to eight times ``block``
    where there are many rows, as each row is sent once for every block of the others.
    """
    cosine = metric == "cosine"

    def find(points: DataFrame) -> DataFrame:
        parts = _blocks(points.count(), block)
        halves = points.select("vid", "vec", F.lit(parts).alias("parts"))
        queries = halves.select("vid", "vec", _dealt("parts").alias("a"), _every("parts").alias("b"))
        others = halves.select("vid", "vec", _every("parts").alias("a"), _dealt("parts").alias("b"))
        compare = lambda q, c: _best(q, c, k + 1, cosine, digits)
        found = queries.groupBy("a", "b").cogroup(others.groupBy("a", "b")).applyInPandas(compare, NEAR)
        return top_per_group(found, ["vid"], [F.col("d"), F.col("near")], k + 1)

    return _search(df, key, F.col(vector).cast("array<double>"), k, cosine, find)


# ---- exact, in the plane ----------------------------------------------------------------


class Grid:
    """Square cells over the points of a plane, of half the size from level to level."""

    def __init__(self, points: DataFrame):
        low = points.agg(F.count("*").alias("n"), *(f(F.col("vec")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in (0, 1))).first()
        self.n = low["n"]
        self.start = (low["min0"], low["min1"])
        self.extent = max(low["max0"] - low["min0"], low["max1"] - low["min1"]) * (1 + 1e-9) if self.n else 0
        self.extent = self.extent or 1.0

    def place(self, axis: int) -> Column:
        """A coordinate as a cell of the finest level."""
        share = (F.col("vec")[axis] - F.lit(self.start[axis])) / F.lit(self.extent)
        return F.least(F.floor(share * (1 << FINEST)), F.lit((1 << FINEST) - 1)).cast("long")

    def border(self, level: Column) -> Column:
        """How far a point (``vec, cx, cy``) is from anything outside its cell and the eight around it."""
        side = F.lit(self.extent) / F.pow(F.lit(2.0), level)
        last = F.pow(F.lit(2.0), level) - 1
        edges = []
        for axis, cell in enumerate(("cx", "cy")):
            at = F.col("vec")[axis] - F.lit(self.start[axis])
            edges.append(F.when(F.col(cell) > 1, at - (F.col(cell) - 1) * side))
            edges.append(F.when(F.col(cell) < last - 1, (F.col(cell) + 2) * side - at))
        return F.coalesce(F.least(*edges), F.lit(float("inf")))


def _around(cells: DataFrame, *others: str) -> DataFrame:
    """Each cell's rows once for each of the nine cells around it, itself included."""
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    return cells.withColumn("_s", F.explode(steps)).select((F.col("cx") + F.col("_s.i")).alias("cx"), (F.col("cy") + F.col("_s.j")).alias("cy"), *others)


def _levels(placed: DataFrame, grid: Grid, need: int, most: int) -> DataFrame:
    """``placed`` (with ``fx, fy``, cells of the finest level) and ``level``: the finest one on which the nine
    cells around a point hold ``need`` points. Levels are as fine as brings every cell to ``most`` points."""
    fine = min(FINEST, max(0, math.ceil(math.log(max(1.0, grid.n / need), 4))))
    cell = lambda level: [F.shiftright("fx", FINEST - level).alias("cx"), F.shiftright("fy", FINEST - level).alias("cy")]
    while True:
        counts = cut_lineage(placed.groupBy(*cell(fine)).agg(F.count("*").alias("n")))
        if fine == FINEST or (counts.agg(F.max("n")).first()[0] or 0) <= most:
            break
        fine = min(FINEST, fine + 2)
    open_cells = counts.select(F.col("cx").alias("fine_x"), F.col("cy").alias("fine_y"))
    known, level = None, fine
    while True:
        around = _around(counts, "n").groupBy("cx", "cy").agg(F.sum("n").alias("around"))
        here = open_cells.select("fine_x", "fine_y", F.shiftright("fine_x", fine - level).alias("cx"), F.shiftright("fine_y", fine - level).alias("cy"))
        told = cut_lineage(here.join(around, ["cx", "cy"]).select("fine_x", "fine_y", ((F.col("around") >= need) | F.lit(level == 0)).alias("settled")))
        settled = told.filter("settled").select("fine_x", "fine_y", F.lit(level).alias("level"))
        known = settled if known is None else known.unionByName(settled)
        open_cells = told.filter("not settled")
        if level == 0 or open_cells.isEmpty():
            break
        level -= 1
        counts = counts.groupBy(F.shiftright("cx", 1).alias("cx"), F.shiftright("cy", 1).alias("cy")).agg(F.sum("n").alias("n"))
    fine_x, fine_y = (c.alias(n) for c, n in zip(cell(fine), ("fine_x", "fine_y")))
    return cut_lineage(placed.withColumns({"fine_x": cell(fine)[0], "fine_y": cell(fine)[1]}).join(known, ["fine_x", "fine_y"]).drop("fine_x", "fine_y"))


def grid_candidates(placed: DataFrame, asked: DataFrame) -> DataFrame:
    """``level, cx, cy, vid, vec``: the points in the nine cells around each cell that ``asked`` (with
    ``level, cx, cy``) names."""
    cells = cut_lineage(asked.select("level", "cx", "cy").distinct())
    steps = _around(cells.withColumnsRenamed({"cx": "ax", "cy": "ay"}).withColumns({"cx": F.col("ax"), "cy": F.col("ay")}), "level", "ax", "ay")
    out = None
    for (level,) in sorted(cells.select("level").distinct().collect()):  # at most FINEST + 1
        own = placed.select("vid", "vec", F.shiftright("fx", FINEST - level).alias("cx"), F.shiftright("fy", FINEST - level).alias("cy"))
        part = skew_join(own, steps.filter(F.col("level") == level), ["cx", "cy"]).select("level", F.col("ax").alias("cx"), F.col("ay").alias("cy"), "vid", "vec")
        out = part if out is None else out.unionByName(part)
    return out


def nearest_in_plane(df: DataFrame, key: str, x: str, y: str, k: int, digits: int = 9, need: int = 256, block: int = BLOCK) -> DataFrame:
    """What ``nearest`` gives for points of a plane, without comparing all with all.

    A point looks into the nine cells of a grid around it, on the finest level on which these
    hold ``need`` points. If its k-th neighbour there is farther away than the border of the nine cells,
    it looks once more on the level whose cells are as large as that distance. Cells
    with very many points are dealt over several tasks. Coordinates must be finite and not null.
    """

    def find(points: DataFrame) -> DataFrame:
        grid = Grid(points)
        if not grid.n:
            return points.sparkSession.createDataFrame([], NEAR)
        placed = cut_lineage(points.select("vid", "vec", grid.place(0).alias("fx"), grid.place(1).alias("fy")))
        open_points = _levels(placed, grid, need, block)
        group = ["level", "cx", "cy"]
        closed = None
        while True:
            asked = open_points.withColumns({"cx": F.expr(f"shiftright(fx, {FINEST} - level)"), "cy": F.expr(f"shiftright(fy, {FINEST} - level)")})
            others = grid_candidates(placed, asked)
            parts = others.groupBy(*group).agg(F.count("*").alias("n")).select(*group, _parts("n", block).alias("parts"))
            share = asked.groupBy(*group).agg(F.count("*").alias("m")).select(*group, _parts("m", block).alias("shares"))
            parts = cut_lineage(parts.join(share, group))
            queries = asked.join(parts, group).select(*group, "vid", "vec", _dealt("shares").alias("a"), "parts").withColumn("b", _every("parts"))
            others = others.join(parts, group).select(*group, "vid", "vec", "shares", _dealt("parts").alias("b")).withColumn("a", _every("shares"))
            compare = lambda q, c: _best(q, c, k + 1, False, digits)
            found = queries.groupBy(*group, "a", "b").cogroup(others.groupBy(*group, "a", "b")).applyInPandas(compare, NEAR)
            found = cut_lineage(top_per_group(found, ["vid"], [F.col("d"), F.col("near")], k + 1))
            far = found.groupBy("vid").agg(F.when(F.count("*") > k, F.max("d") + 2 * 10.0**-digits).alias("far"))
            told = asked.join(far, "vid", "left").withColumn("border", grid.border(F.col("level")))
            told = cut_lineage(told.withColumn("done", (F.col("level") == 0) | F.coalesce(F.col("far") <= F.col("border"), F.lit(False))))
            kept = found.join(told.filter("done").select("vid"), "vid", "left_semi")
            closed = kept if closed is None else closed.unionByName(kept)
            left = told.filter("not done")
            if left.isEmpty():
                return closed
            wide = F.floor(F.log2(F.lit(grid.extent) / F.col("far"))).cast("int")
            open_points = left.withColumn("level", F.greatest(F.lit(0), F.least(F.col("level") - 1, F.coalesce(wide, F.col("level") - 1)))).select("vid", "vec", "fx", "fy", "level")

    return _search(df, key, F.array(F.col(x).cast("double"), F.col(y).cast("double")), k, False, find)


# ---- over inverted lists ----------------------------------------------------------------


def inverted_lists(points: DataFrame, size: int, fan: int, probes: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``vid, vec, list`` twice: where each point is kept (one list) and where it looks (``probes`` lists).

    Lists of more than ``size`` points are cut into up to ``fan`` lists around some of
    their points, again and again. A point is kept in the list of its nearest centre; where it looks, the
    lists of the nearest centres are followed, ``probes`` of them on each level, so neither
    number grows with the points.
    """
    own = cut_lineage(points.select("vid", "vec", F.lit("0").alias("list")))
    look = own.withColumn("sim", F.lit(1.0))
    while True:
        counts = own.groupBy("list").agg(F.count("*").alias("n"))
        deep = F.size(F.split("list", "[.]")) > DEEPEST  # vectors that no centre tells apart
        large = cut_lineage(counts.filter((F.col("n") > size) & ~deep).select("list", F.least(F.lit(fan), F.ceil(F.col("n") / (size / 2))).cast("int").alias("fan")))
        if large.isEmpty():
            return own, look.select("vid", "vec", "list")
        turn = [F.xxhash64("list", "vid"), F.col("vid")]
        centres = top_per_group(own.join(large.select("list"), "list", "left_semi"), ["list"], turn, fan, "turn")
        centres = cut_lineage(centres.join(large, "list").filter("turn <= fan").select("list", "turn", "vec"))

        def down(rows: DataFrame, most: int) -> DataFrame:
            """Rows of large lists in the lists of their ``most`` nearest centres."""
            many = rows.join(large, "list").groupBy("list").agg(F.count("*").alias("m")).select("list", _parts("m", 4 * block).alias("parts"))
            left = rows.join(many, "list").select("list", "vid", "vec", _dealt("parts").alias("part"))
            right = centres.join(many, "list").select("list", "turn", "vec", _every("parts").alias("part"))

            def near(key: tuple, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
                sim = _matrix(q["vec"]) @ _matrix(c["vec"]).T
                turns = c["turn"].to_numpy()
                keep = min(most, len(turns))
                order = np.lexsort((np.broadcast_to(turns, sim.shape), -sim), axis=1)[:, :keep]
                names = np.array([f"{key[0]}.{t}" for t in turns], object)
                every = np.repeat(np.arange(len(q)), keep)
                return pd.DataFrame({"vid": q["vid"].to_numpy()[every], "vec": q["vec"].to_numpy()[every], "list": names[order].ravel(), "sim": np.take_along_axis(sim, order, 1).ravel()})

            by = ["list", "part"]
            return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(near, "vid bigint, vec array<double>, list string, sim double")

        small = lambda rows: rows.join(large.select("list"), "list", "left_anti")
        following = small(look).unionByName(down(look.select("list", "vid", "vec"), probes))
        look = cut_lineage(top_per_group(following, ["vid"], [F.desc("sim"), F.col("list")], probes))
        own = cut_lineage(small(own).unionByName(down(own, 1).drop("sim")))


def nearest_by_lists(df: DataFrame, key: str, vector: str, k: int, digits: int = 9, size: int = 256, fan: int = 64, probes: int = 10, block: int = BLOCK) -> DataFrame:
    """What ``nearest`` gives by cosine, but among the rows of ``probes`` inverted lists of at most ``size`` vectors
    each: similarities are exact, and some of the nearest may be missing. Zero vectors must be left out."""

    def find(points: DataFrame) -> DataFrame:
        kept, look = inverted_lists(points, size, fan, probes, block)
        many = look.groupBy("list").agg(F.count("*").alias("m")).select("list", _parts("m", block).alias("parts"))
        queries = look.join(many, "list").select("list", "vid", "vec", _dealt("parts").alias("part"))
        others = kept.join(many, "list").select("list", "vid", "vec", _every("parts").alias("part"))
        compare = lambda q, c: _best(q, c, k + 1, True, digits)
        found = queries.groupBy("list", "part").cogroup(others.groupBy("list", "part")).applyInPandas(compare, NEAR)
        return top_per_group(found, ["vid"], [F.col("d"), F.col("near")], k + 1)

    return _search(df, key, F.col(vector).cast("array<double>"), k, True, find)


# ---- edges ------------------------------------------------------------------------------


def thematic_edges(df: DataFrame, key: str, vector: str, k: int, block: int = BLOCK, exact: bool = True) -> DataFrame:
    """Directed similarity edges (src, dst, sim): cosine kNN of the embedding, exact or over inverted lists."""
    found = nearest(df, key, vector, k, "cosine", block=block) if exact else nearest_by_lists(df, key, vector, k, block=block)
    return found.select(F.col(key).alias("src"), F.col("neighbour").alias("dst"), F.col("value").alias("sim"))


def symmetric_edges(edges: DataFrame) -> DataFrame:
    """Both directions of every edge with the larger similarity of the pair."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "sim")
    return edges.select("src", "dst", "sim").unionByName(back).groupBy("src", "dst").agg(F.max("sim").alias("sim"))


def top_neighbours(edges: DataFrame, k: int = 4) -> DataFrame:
    """Most similar neighbours of each node over symmetric edges."""
    return top_per_group(symmetric_edges(edges), ["src"], [F.desc("sim"), F.col("dst")], k, "position")
