"""Near-duplicate vectors by dual traversal of cover trees.

Within one label (and dimension), unit vectors with a cosine of ``c`` or more lie within ``sqrt(2 - 2c)``. A cover tree
holds nested levels of centres: those of a level are at least its radius apart and every point has a centre of each
level within its radius; radii halve from level to level and the last level is the points themselves. Each node
knows how far the farthest point beneath it is. Two nodes whose centres are farther apart than the limit plus both
of these radii have no link between their points; if distance and radii together stay within the limit, all
their points are linked, which is counted without looking at them. All other node pairs are opened.

The tree has two parts. Its top is made per label from a bounded sample of points and every point descends through
it to the last centre whose radius holds it: its cell. Pairs of cells are opened from the root on, once per label.
The points of a cell are dealt out to blocks of bounded size, each with a tree of its own, and the pairs of blocks of
the cell pairs that are left are traversed in the same way, several blocks at a time against a stream of others.
Links are counted exactly. They are never listed: blocks keep the components of their own links, and a pair of blocks
gives the few links that join components.

Rows with the same vector are one point that counts several times.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components, forest

#: Points of a block at most, blocks that a task holds at a time, points for which the top gets one more centre,
#: centres of a top at most, points that share one copy of it.
BLOCK, HELD, PER_CENTRE, CENTRES, SHARE = 2048, 4, 1024, 2048, 1 << 16
#: Levels above the points: radii 2 (all unit vectors), 1, 1/2, 1/4, 1/8.
RADII = [2.0, 1.0, 0.5, 0.25, 0.125]
#: What node bounds may be wrong by; cosines of points this near to the threshold are computed again, term by term.
SLACK, CLOSE = 1e-6, 1e-9
NODE = 24
_BLOCK = "label string, dim int, cell int, part int, nodes binary, weights binary, vectors binary, sizes binary, above binary, radii binary, own binary, joined binary"


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1)[:, None]
    return vectors / np.sqrt((vectors**2).sum(1))[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def nested(points: np.ndarray) -> tuple[np.ndarray, list[int], list[np.ndarray]]:
    """An order of the points in which the centres of each level are the first ones, how many there are, and for each
    point in that order the centre above it on each level (the nearest one, through the centres between)."""
    apart = distances(points, points)
    np.fill_diagonal(apart, 0)
    order: list[int] = [0]
    near = apart[0].copy()
    sizes, above = [1], [np.zeros(len(points), np.int64)]
    for radius in RADII[1:]:
        while True:
            left = np.flatnonzero(near > radius)
            if not len(left):
                break
            order.append(int(left[0]))
            np.minimum(near, apart[left[0]], out=near)
        sizes.append(len(order))
    seen = np.zeros(len(points), bool)
    seen[order] = True
    order = np.concatenate([order, np.flatnonzero(~seen)]).astype(np.int64)
    # From the points upwards: a point's centre on a level is that of its centre on the level beneath.
    above = [np.arange(len(points))]
    for n in reversed(sizes):
        centres = order[:n]
        parent = apart[np.ix_(order, centres)].argmin(1)
        parent[:n] = np.arange(n)
        above.insert(0, parent[above[0]])
    return order, sizes, above


def reaches(points: np.ndarray, sizes: list[int], above: list[np.ndarray]) -> list[np.ndarray]:
    """How far the farthest point beneath each centre is, level by level; ``points`` in the order of the tree."""
    out = []
    for n, up in zip(sizes, above):
        far = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", points, points[up])))
        far[: min(n, len(far))][up[:n] == np.arange(n)] = 0
        radius = np.zeros(n)
        np.maximum.at(radius, up, far)
        out.append(radius)
    return out


class Tree:
    """A block: points in the order of its tree, the levels worth a look, and the points as the last one."""

    def __init__(self, row: dict):
        self.key = tuple(row[c] for c in ("label", "dim", "cell", "part"))
        self.nodes = np.frombuffer(row["nodes"], f"S{NODE}")
        part = lambda name, kind: np.frombuffer(row[name], kind)
        self.weights = part("weights", np.int64)
        n = len(self.weights)
        self.raw = part("vectors", np.float64).reshape(n, -1)
        self.points = unit(self.raw)
        self.sizes = [*part("sizes", np.int32).tolist(), n]
        self.above = [*part("above", np.int32).reshape(len(RADII), n).astype(np.int64), np.arange(n)]
        self.radii = [*np.split(part("radii", np.float64), np.cumsum(self.sizes[:-1])[:-1]), np.zeros(n)]
        self.joined = part("joined", np.int32).astype(np.int64) if row["joined"] is not None else None

    def below(self, level: int) -> np.ndarray:
        """How many vectors stand beneath each node of a level."""
        return np.bincount(self.above[level], self.weights, minlength=self.sizes[level])


def traverse(a: Tree, b: Tree, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Linked vectors of ``b`` for each point of ``a`` and the other way round, and links (points of both sides) that
    connect what all links connect."""
    limit = math.sqrt(2 - 2 * least)
    count_a, count_b = np.zeros(len(a.points)), np.zeros(len(b.points))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    last = len(RADII)
    # A level is worth a look if it has at most half as many nodes on both sides as the points.
    levels = [k for k in range(last) if 2 * a.sizes[k] <= len(a.points) and 2 * b.sizes[k] <= len(b.points)]
    levels = [k for i, k in enumerate(levels) if i + 1 == len(levels) or 2 * a.sizes[k] * b.sizes[k] <= a.sizes[levels[i + 1]] * b.sizes[levels[i + 1]]]
    live = None
    for level in [*levels, last]:
        n, m = a.sizes[level], b.sizes[level]
        rows, columns = np.arange(n), np.arange(m)
        if live is not None:
            up, over = a.above[before][:n], b.above[before][:m]
            rows, columns = rows[live.any(1)[up]], columns[live.any(0)[over]]
            if not len(rows) or not len(columns):
                break
            open_ = live[np.ix_(up[rows], over[columns])]
        else:
            open_ = np.ones((n, m), bool)
        if level == last:
            close = a.points[rows] @ b.points[columns].T
            whole = close >= least
            for i, j in zip(*np.nonzero(np.abs(close - least) < CLOSE)):
                p, q = a.raw[rows[i]], b.raw[columns[j]]
                whole[i, j] = math.fsum(p * q) / (math.sqrt(math.fsum(p * p)) * math.sqrt(math.fsum(q * q))) >= least
            whole &= open_
        else:
            apart = distances(a.points[rows], b.points[columns])
            reach = a.radii[level][rows][:, None] + b.radii[level][columns]
            whole = open_ & (apart + reach <= limit - SLACK)
            live = np.zeros((n, m), bool)
            live[np.ix_(rows, columns)] = open_ & ~whole & (apart - reach <= limit + SLACK)
            before = level
        if whole.any():
            i, j = np.nonzero(whole)
            i, j = rows[i], columns[j]
            count_a += np.bincount(i, b.below(level)[j], minlength=n)[a.above[level]]
            count_b += np.bincount(j, a.below(level)[i], minlength=m)[b.above[level]]
            left.append(i)
            right.append(j)
            if level != last:  # the points beneath a node are linked to the centre of a node on the other side
                for mine, its, one, two in ((i, j, a, left), (j, i, b, right)):
                    node, first = np.unique(mine, return_index=True)
                    partner = np.full(one.sizes[level], -1)
                    partner[node] = its[first]
                    points = np.flatnonzero(partner[one.above[level]] >= 0)
                    two.append(points)
                    (right if two is left else left).append(partner[one.above[level]][points])
        if level == last:
            break
    none = np.zeros(0, np.int64)
    return count_a, count_b, np.concatenate(left) if left else none, np.concatenate(right) if right else none


def _rows(made: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "boolean": pa.bool_()}
    names, types = zip(*(c.split() for c in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*made), types)], names=list(names))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _top(sample: DataFrame) -> DataFrame:
    """The top of each label's tree: one row with its centres, the numbers of centres of the levels and the centre above each."""

    def work(table: pa.Table) -> pa.Table:
        label, dim = table.column("label")[0].as_py(), table.column("dim")[0].as_py()
        table = table.sort_by("turn").slice(0, table.column("wanted")[0].as_py())
        points = unit(_vectors(table.column("vec").combine_chunks(), dim))
        order, sizes, above = nested(points)
        points, above = points[order], [x.astype(np.int32) for x in above[:-1]]
        made = [[label, dim, points.tobytes(), np.array(sizes, np.int32).tobytes(), np.concatenate(above).tobytes()]]
        return pa.Table.from_batches([_rows(made, "label string, dim int, centres binary, sizes binary, above binary")])

    return sample.groupBy("label", "dim").applyInArrow(work, "label string, dim int, centres binary, sizes binary, above binary")


class _Top:
    def __init__(self, row: dict):
        self.dim = row["dim"]
        self.centres = np.frombuffer(row["centres"], np.float64).reshape(-1, self.dim)
        self.sizes = np.frombuffer(row["sizes"], np.int32).tolist()
        self.above = np.frombuffer(row["above"], np.int32).reshape(len(RADII), -1)

    def cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each point's cell, its last centre and that one's level in one number, and the distance to the centre."""
        apart = distances(points, self.centres)
        every = np.arange(len(points))
        at, level = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        for k in range(1, len(RADII)):
            n = self.sizes[k]
            # Children stand beneath the centre that the point has reached.
            mine = np.where(self.above[k - 1][:n][None, :] == at[:, None], apart[:, :n], np.inf)
            child = mine.argmin(1)
            down = (level == k - 1) & (mine[every, child] <= RADII[k])
            at[down], level[down] = child[down], k
        return level * CENTRES + at, apart[every, at]

    def pairs(self, cells: dict[int, float], limit: float) -> Iterator[tuple[int, int, bool]]:
        """Pairs of cells that may hold links, each once, and whether all their points are linked: opened from
        the root on. ``cells`` has the reach of each cell."""
        depth = len(RADII)
        reach = [np.full(n, -1.0) for n in self.sizes]
        own = [np.full(n, -1.0) for n in self.sizes]
        for cell, far in cells.items():
            own[cell // CENTRES][cell % CENTRES] = far
        for k in range(depth - 1, -1, -1):
            reach[k] = own[k].copy()
            if k + 1 < depth:
                n = self.sizes[k + 1]
                up = self.above[k][:n]
                far = np.where(reach[k + 1] >= 0, np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", self.centres[:n], self.centres[up]))) + reach[k + 1] + SLACK, -1)
                np.maximum.at(reach[k], up, far)

        children: list[list[list[int]]] = []
        for k in range(depth - 1):
            kids: list[list[int]] = [[] for _ in range(self.sizes[k])]
            for c, p in enumerate(self.above[k][: self.sizes[k + 1]].tolist()):
                if reach[k + 1][c] >= 0:
                    kids[p].append(c)
            children.append(kids)
        # A side of a pair is a node with all beneath it or, where a point stays there, its own cell.
        front = np.array([[0, 0, 0, 0, 0, 0]])
        if reach[0][0] < 0:
            return
        while len(front):
            far = np.empty((len(front), 2))
            for side in (0, 1):
                level, node, only = front[:, 3 * side], front[:, 3 * side + 1], front[:, 3 * side + 2]
                for k in range(depth):
                    mine = level == k
                    far[mine, side] = np.where(only[mine] == 1, own[k][node[mine]], reach[k][node[mine]])
            apart = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ij,ij->i", self.centres[front[:, 1]], self.centres[front[:, 4]])))
            live = apart - far.sum(1) <= limit + SLACK
            whole = apart + far.sum(1) <= limit - SLACK
            following: list[list[int]] = []
            for pair, all_in in zip(front[live].tolist(), whole[live].tolist()):
                a, b = pair[:3], pair[3:]
                if a[2] and b[2]:
                    yield a[0] * CENTRES + a[1], b[0] * CENTRES + b[1], all_in
                    continue

                def opened(side: list[int]) -> list[list[int]]:
                    level, node, only = side
                    if only:
                        return [side]
                    out = [[level, node, 1]] if own[level][node] >= 0 else []
                    return out + ([[level + 1, c, 0] for c in children[level][node]] if level + 1 < depth else [])

                if a == b:
                    parts = opened(a)
                    following += [x + y for i, x in enumerate(parts) for y in parts[i:]]
                else:
                    following += [x + y for x in opened(a) for y in opened(b)]
            front = np.array(following).reshape(-1, 6)


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row: how many other rows with the same label have a cosine of
    ``least`` (between 0 and 1) or more, the least id of those reached by such links, and whether that is the row's own.

    Rows without id or label, null or zero vectors and vectors with null or non-finite components are linked with
    nothing; theirs is the component of their own id, and they are kept. Vectors are compared with those of the
    same dimension. Rows repeated with the same vector are linked with each other, also under one id. Other columns
    aren't read, whatever their names; an empty table gives an empty result.
    """
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    able = F.coalesce(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & fine, F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), v.alias("vec"), able.alias("able"))
    key = [F.xxhash64(F.lit(k), "label", "vec").alias(f"k{k}") for k in (1, 2)]
    same = rows.filter("able").groupBy(*key).agg(F.count("*").alias("weight"), F.min("vec_id").alias("low"), F.first(F.struct("label", "vec")).alias("one"))
    bytes_of = lambda c: F.unhex(F.lpad(F.hex(F.col(c).bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    # In the order of the ids, so that the least node of a component has its least id.
    points = same.select(F.concat(bytes_of("low"), bytes_of("k1"), bytes_of("k2")).alias("node"), "k1", "k2", "weight", "one.label", F.size("one.vec").alias("dim"), "one.vec")
    points = cut_lineage(points)
    counts, links = _linked(points, least)
    found = components(links)
    low = lambda c: F.conv(F.hex(F.substring(c, 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    counts = counts.groupBy("node").agg(F.sum("n").alias("n"))
    told = points.select("node", "k1", "k2", "weight").join(counts, "node", "left").join(found, "node", "left")
    told = told.select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), low(F.coalesce("root", "node")).alias("component_id"))
    named = rows.select("vec_id", *(F.when(F.col("able"), k).alias(n) for n, k in zip(("k1", "k2"), key))).join(told, ["k1", "k2"], "left")
    own = F.coalesce("component_id", "vec_id")
    return named.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))


def _linked(points: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """``node, n``: numbers of linked vectors (to be summed), its own point's left out, and ``a, b``: links between nodes."""
    limit = math.sqrt(2 - 2 * least)
    group = ["label", "dim"]
    sizes = points.groupBy(*group).agg(F.count("*").alias("total"))
    turn = Window.partitionBy(*group).orderBy(F.xxhash64("node"), "node")
    sample = points.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= CENTRES).join(sizes, group)
    wanted = F.least(F.lit(CENTRES), F.ceil(F.col("total") / PER_CENTRE)).cast("int")
    tops = cut_lineage(_top(sample.select(*group, "vec", "turn", wanted.alias("wanted")).filter("turn <= wanted")))

    # Points descend through copies of their label's top, each for a bounded number of points.
    shares = sizes.withColumn("shares", F.ceil(F.col("total") / SHARE).cast("int"))
    copies = tops.join(shares, group).withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    dealt = points.join(shares, group).withColumn("share", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int"))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    both = copies.select(*group, "share", F.lit(0).alias("side"), none("binary", "node"), none("bigint", "weight"), none("array<double>", "vec"), "centres", "sizes", "above").unionByName(
        dealt.select(*group, "share", F.lit(1).alias("side"), "node", "weight", "vec", none("binary", "centres"), none("binary", "sizes"), none("binary", "above"))
    )
    schema = "label string, dim int, cell int, far double, node binary, weight bigint, vec array<double>"

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = None
        for batch in batches:
            heads = np.flatnonzero(batch.column("side").to_numpy() == 0).tolist()
            for a, b in zip([-1, *heads], [*heads, batch.num_rows]):
                if a >= 0:
                    top = _Top(batch.slice(a, 1).to_pylist()[0])
                part = batch.slice(a + 1, b - a - 1)
                if part.num_rows:
                    cell, far = top.cells(unit(_vectors(part.column("vec"), top.dim)))
                    columns = [part.column("label"), part.column("dim"), pa.array(cell, pa.int32()), pa.array(far), *(part.column(c) for c in ("node", "weight", "vec"))]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    placed = both.repartition(*group, "share").sortWithinPartitions(*group, "share", "side").mapInArrow(descend, schema)
    placed = cut_lineage(placed)
    group_cell = [*group, "cell"]
    cells = cut_lineage(placed.groupBy(*group_cell).agg(F.count("*").alias("n"), F.max("far").alias("far"), F.sum("weight").alias("weight"), F.min("node").alias("low")))

    def open_pairs(key, top: pa.Table, mine: pa.Table) -> pa.Table:
        label, dim = (k.as_py() for k in key)
        reach = dict(zip(mine.column("cell").to_pylist(), mine.column("far").to_pylist()))
        made = [[label, dim, min(a, b), max(a, b), whole] for row in top.to_pylist() for a, b, whole in _Top(row).pairs(reach, limit)]
        schema = "label string, dim int, a int, b int, whole boolean"
        return pa.Table.from_batches([_rows(made, schema)] if made else [], _rows([["", 0, 0, 0, True]], schema).schema)

    # The cells of a label are as bounded in number as the centres of its top.
    opened = tops.groupBy(*group).cogroup(cells.groupBy(*group)).applyInArrow(open_pairs, "label string, dim int, a int, b int, whole boolean")
    opened = cut_lineage(opened)

    # Cells that are linked as a whole: counts by the weight of the cell, links to one of its points.
    named = lambda c: cells.select(*group, F.col("cell").alias(c), F.col("weight").alias(f"w_{c}"), F.col("low").alias(f"low_{c}"))
    whole = opened.filter("whole").join(named("a"), [*group, "a"]).join(named("b"), [*group, "b"])
    sides = whole.select(*group, F.col("a").alias("cell"), F.col("w_b").alias("w"), F.col("low_b").alias("to"))
    sides = sides.unionByName(whole.filter("a <> b").select(*group, F.col("b").alias("cell"), F.col("w_a").alias("w"), F.col("low_a").alias("to")))
    sides = sides.groupBy(*group_cell).agg(F.sum("w").alias("w"), F.min("to").alias("to"))
    within = cells.select(*group_cell).join(opened.filter("whole and a = b").select(*group, F.col("a").alias("cell"), F.lit(True).alias("self")), group_cell, "left")
    told = placed.select(*group_cell, "node", "weight").join(sides.join(within, group_cell), group_cell)
    by_cell = told.select("node", (F.col("w") - F.when(F.col("self"), F.col("weight")).otherwise(0)).cast("long").alias("n"))
    cell_links = told.select(F.col("node").alias("a"), F.col("to").alias("b")).unionByName(whole.select(F.col("low_a").alias("a"), F.col("low_b").alias("b")))

    # Blocks of the cells that have pairs to open.
    pairs = opened.filter("not whole")
    wanted = pairs.select(*group, F.explode(F.array_distinct(F.array("a", "b"))).alias("cell")).distinct()
    parts = cells.join(wanted, group_cell).select(*group_cell, F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    packed = placed.join(parts, group_cell).withColumn("part", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("parts")).cast("int"))
    packed = packed.select(*group_cell, "part", "node", "weight", "vec").repartition(*group_cell, "part").sortWithinPartitions(*group_cell, "part", "node")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        current = None

        def block() -> pa.RecordBatch:
            nodes, weights, raw = (np.concatenate(x) for x in zip(*held))
            order, sizes, above = nested(unit(raw))
            nodes, weights, raw = nodes[order], weights[order], raw[order]
            above = above[:-1]
            row = dict(zip(("label", "dim", "cell", "part"), current)) | {"nodes": nodes.tobytes(), "weights": weights.tobytes(), "vectors": raw.tobytes(), "sizes": np.array(sizes, np.int32).tobytes()}
            row |= {"above": np.concatenate(above).astype(np.int32).tobytes(), "joined": None}
            row["radii"] = np.concatenate(reaches(unit(raw), sizes, above)).tobytes()
            tree = Tree(row)
            own, _, a, b = traverse(tree, tree, least)
            row["own"], row["joined"] = (np.rint(own).astype(np.int64) - weights).tobytes(), forest(len(nodes), a, b).astype(np.int32).tobytes()
            return _rows([[row[c.split()[0]] for c in _BLOCK.split(", ")]], _BLOCK)

        for batch in batches:
            dims = batch.column("dim").to_pylist()
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "cell", "part"))))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if keys[a] != current:
                    if held:
                        yield block()
                    held, current = [], keys[a]
                part = batch.slice(a, b - a)
                nodes = np.array(part.column("node").to_pylist(), f"S{NODE}")
                held.append((nodes, part.column("weight").to_numpy(), _vectors(part.column("vec"), dims[a])))
        if held:
            yield block()

    blocks = cut_lineage(packed.mapInArrow(pack, _BLOCK))
    group_part = [*group_cell, "part"]
    kept = blocks.select(*group_part)
    hold = kept.withColumn("turn", F.floor(F.col("part") / HELD).cast("int"))
    # The right side of each pair is the later block; a task holds some blocks of one cell and reads those to come.
    right = lambda c: kept.select(*group, F.col("cell").alias(c), F.col("part").alias(f"{c}_part"))
    meets = pairs.join(hold.select(*group, F.col("cell").alias("a"), "turn").distinct(), [*group, "a"]).join(right("b"), [*group, "b"])
    meets = meets.filter((F.col("a") < F.col("b")) | (F.col("b_part") > F.col("turn") * HELD)).select(*group, "a", "turn", F.col("b").alias("cell"), F.col("b_part").alias("part"))
    columns = [c.split()[0] for c in _BLOCK.split(", ") if c.split()[0] != "own"]
    sent = blocks.select(*columns).join(meets, group_part).select(*columns, "a", "turn", F.lit(1).alias("side"))
    holders = meets.select(*group, F.col("a").alias("cell"), "turn").distinct()
    stay = blocks.select(*columns).withColumn("turn", F.floor(F.col("part") / HELD).cast("int")).join(holders, [*group_cell, "turn"], "left_semi")
    tiles = stay.select(*columns, F.col("cell").alias("a"), "turn", F.lit(0).alias("side")).unionByName(sent)
    answer = "nodes binary, counts binary, a binary, b binary"

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Tree] = []
        counts: list[np.ndarray] = []
        current = None

        def told(tree: Tree, count: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            used = count > 0
            return _rows([[tree.nodes[used].tobytes(), np.rint(count[used]).astype(np.int64).tobytes(), a.tobytes(), b.tobytes()]], answer)

        nothing = np.zeros(0, f"S{NODE}")
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                key = (row["label"], row["dim"], row["a"], row["turn"])
                if key != current:
                    for tree, count in zip(held, counts):
                        if count.any():
                            yield told(tree, count, nothing, nothing)
                    held, counts, current = [], [], key
                tree = Tree(row)
                if row["side"] == 0:
                    held.append(tree)
                    counts.append(np.zeros(len(tree.points)))
                    continue
                mine = np.zeros(len(tree.points))
                ends: list[tuple[np.ndarray, np.ndarray]] = []
                for other, count in zip(held, counts):
                    if other.key >= tree.key:
                        continue
                    first, second, a, b = traverse(other, tree, least)
                    count += first
                    mine += second
                    if len(a):  # links between components, as few as connect the same
                        n = len(other.points)
                        whole = forest(n + len(tree.points), other.joined[a], tree.joined[b] + n)
                        both = np.concatenate([other.nodes, tree.nodes])
                        bound = np.flatnonzero(whole != np.arange(len(whole)))
                        ends.append((both[bound], both[whole[bound]]))
                if mine.any() or ends:
                    a, b = (np.concatenate(x) for x in zip(*ends)) if ends else (nothing, nothing)
                    yield told(tree, mine, a, b)
        for tree, count in zip(held, counts):
            if count.any():
                yield told(tree, count, nothing, nothing)

    met = cut_lineage(tiles.repartition(*group, "a", "turn").sortWithinPartitions(*group, "a", "turn", "side").mapInArrow(meet, answer))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's own counts, if its cell isn't linked as a whole, and what its components are."""
        for batch in batches:
            for row in batch.to_pylist():
                nodes, own, joined = np.frombuffer(row["nodes"], f"S{NODE}"), np.frombuffer(row["own"], np.int64), np.frombuffer(row["joined"], np.int32)
                used, bound = (own > 0) & (not row["self"]), np.flatnonzero(joined != np.arange(len(joined)))
                if used.any() or len(bound):
                    yield _rows([[nodes[used].tobytes(), own[used].tobytes(), nodes[bound].tobytes(), nodes[joined[bound]].tobytes()]], answer)

    inner = blocks.select(*group_cell, "nodes", "own", "joined").join(within, group_cell).select("nodes", "own", "joined", F.coalesce("self", F.lit(False)).alias("self")).mapInArrow(alone, answer)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                # Slices, since an item of a fixed-width string loses its trailing zeros.
                node = [row["nodes"][i : i + NODE] for i in range(0, len(row["nodes"]), NODE)]
                if node:
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.binary()), pa.array(np.frombuffer(row["counts"], np.int64))], names=["node", "n"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = ([row[c][i : i + NODE] for i in range(0, len(row[c]), NODE)] for c in ("a", "b"))
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    every = met.unionByName(inner)
    counts = by_cell.unionByName(every.select("nodes", "counts").mapInArrow(numbers, "node binary, n bigint"))
    return counts, cell_links.unionByName(every.select("a", "b").mapInArrow(ends, "a binary, b binary"))
