"""What both searches for repeated passages share: bringing texts that may repeat to one place.

A window is ``window`` consecutive units (bytes or words) of one text. The least hash of the ``gram``-unit runs
inside a window is its anchor; equal windows have equal anchors, wherever they are. Consecutive windows with one
anchor form a run, and the text a run spans is a segment. Only segments whose anchor occurs at least twice can
hold a repeated window; they are sent to the partition of their anchor, where an index over the distinct
segments decides. Rows with the same text are one text that counts twice.

Anchors of more than ``crowd`` texts (a passage that a large part of the corpus shares) would fill one task;
their windows are dealt out by content instead, as hashes of whole windows that are counted like words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import packed, text_key, texts_of, unpacked

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Units handled at a time in a worker, and windows in one segment at most.
PIECE, LONGEST = 1 << 20, 1024
_TABLES = np.random.default_rng(7).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _C2
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown as needed: workers hold them from then on."""

    base = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 12)
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                row = np.full(size, base, np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit polynomial hash of data[start:end] for each span; ``data`` is bytes, or 64-bit hashes."""
    up, down = _POWERS(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    units = _TABLES[which][data] if data.dtype == np.uint8 else mix(data + _TABLES[which][0])
    np.cumsum(units * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


class Bytes:
    """Units are the bytes of the text as UTF-8."""

    gram = 64

    @staticmethod
    def units(text: bytes) -> np.ndarray:
        return np.frombuffer(text, np.uint8)

    @staticmethod
    def cutter(text: bytes) -> Callable[[int, int], bytes]:
        return lambda start, end: text[start:end]

    @staticmethod
    def load(segments: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(s, np.uint8) for s in segments]

    @staticmethod
    def size(segment: bytes) -> int:
        return len(segment)

    @classmethod
    def grams(cls, units: np.ndarray) -> np.ndarray:
        raw = np.concatenate([units, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(units),), "<u8", raw, strides=(1,)).copy()
        n = len(units) - cls.gram + 1
        h = eight[:n].copy()
        for shift in range(8, cls.gram, 8):
            h ^= h >> np.uint64(31)
            h *= _C1
            h += eight[shift : shift + n]
        return mix(h * _C1)


class Words:
    """Units are words, runs of bytes other than ASCII white space, each as a 64-bit hash."""

    gram = 6

    @staticmethod
    def cutter(text: bytes) -> Callable[[int, int], bytes]:
        words = text.split()  # at ASCII white space
        return lambda start, end: b" ".join(words[start:end])

    @staticmethod
    def load(segments: list[bytes]) -> list[np.ndarray]:
        ends = np.cumsum([Words.size(s) for s in segments])
        return np.split(Words.units(b" ".join(segments)), ends[:-1])

    @staticmethod
    def size(segment: bytes) -> int:
        return segment.count(b" ") + 1

    @staticmethod
    def units(text: bytes) -> np.ndarray:
        out = []
        for start in range(0, len(text), PIECE):  # long texts in pieces that end at white space
            end = min(len(text), start + PIECE)
            out.append((start, end))
        data = np.frombuffer(text, np.uint8)
        if len(out) > 1:
            cuts = [0]
            for _, end in out[:-1]:
                tail = np.flatnonzero(_SPACE[data[max(end, cuts[-1]) :]])
                cuts.append(max(end, cuts[-1]) + int(tail[0]) if len(tail) else len(data))
            cuts.append(len(data))
            return np.concatenate([Words._hashed(data[a:b]) for a, b in zip(cuts, cuts[1:])])
        return Words._hashed(data)

    @staticmethod
    def _hashed(data: np.ndarray) -> np.ndarray:
        inside = np.concatenate([[0], ~_SPACE[data], [0]]).astype(np.int8)
        edge = np.diff(inside)
        return span_hashes(data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)) if len(data) else np.zeros(0, np.uint64)

    @classmethod
    def grams(cls, units: np.ndarray) -> np.ndarray:
        n = len(units) - cls.gram + 1
        h = units[:n].copy()
        for shift in range(1, cls.gram):
            h ^= h >> np.uint64(31)
            h *= _C1
            h += units[shift : shift + n]
        return mix(h * _C1)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    n = len(values)
    full = -(-n // width) * width
    padded = np.concatenate([values, np.full(full - n, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(units: np.ndarray, window: int, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the runs of windows of one text: anchor, first window, number of windows, and 2 if the anchor
    stands at several places of the run (then windows of the same run may be equal), else 1."""
    parts, total = [], len(units) - window + 1
    for start in range(0, max(0, total), PIECE):
        piece = units[start : min(len(units), start + PIECE + window - 1)]
        grams, width = kind.grams(piece), window - kind.gram + 1
        least = sliding_min(grams, width)
        # A gram is the least of some window if it equals the largest of the minima of the windows around it.
        edge = np.full(width - 1, np.iinfo(np.uint64).max, np.uint64)
        around = ~sliding_min(np.concatenate([edge, ~least, edge]), width)
        held = grams[grams == around]
        several = np.unique(held[1:][held[1:] == held[:-1]])
        cut = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]])
        sizes = np.diff(cut)
        times = -(-sizes // LONGEST)
        if (times > 1).any():  # long runs of one anchor are cut; an anchor's segments meet in any case
            run = np.repeat(np.arange(len(sizes)), times)
            nth = np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)
            first = cut[:-1][run] + nth * LONGEST
            size = np.minimum(LONGEST, sizes[run] - nth * LONGEST)
        else:
            first, size = cut[:-1], sizes
        h = least[first]
        parts.append((h.view(np.int64), first + start, size, 1 + np.isin(h, several)))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*parts))


_ANCHOR = "array<struct<h:bigint,a:int,m:int,c:int>>"
_PIECE = "h bigint, g bigint, seg binary, key binary, a int, w int"


def _anchored(rows: DataFrame, window: int, kind) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [anchors(kind.units(t.encode()), window, kind) for t in texts_of(batch)]
            ends = np.concatenate([[0], np.cumsum([len(m[0]) for m in made])]).astype(np.int32)
            h, *rest = (np.concatenate([x[i] for x in made]) if made else np.zeros(0, np.int64) for i in range(4))
            fields = [pa.array(h), *(pa.array(x.astype(np.int32)) for x in rest)]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, names=["h", "a", "m", "c"]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), lists], names=["key", "doc_id", "anchors"])

    return rows.mapInArrow(run, f"key binary, doc_id bigint, anchors {_ANCHOR}")


def _cut(rows: DataFrame, window: int, kind) -> DataFrame:
    """Segments of ordinary anchors as bytes, and, of crowded ones, two hashes of each of their windows: ``seg`` or ``g``
    is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[list] = [[], [], [], [], [], []]
            size = 0
            for text, key, n, hot, found in zip(unpacked(batch.column("text")), *(batch.column(c).to_pylist() for c in ("key", "n", "hot", "found"))):
                units, cut, w = kind.units(text) if hot else None, kind.cutter(text), min(n, 2)
                for x in found:
                    a, m = x["a"], x["m"]
                    if x["hot"]:
                        piece, at = units[a : a + m + window - 1], np.arange(m)
                        made = [span_hashes(piece, at, at + window, which).view(np.int64).tolist() for which in (0, 1)]
                        for row, v in zip(held, (made[0], made[1], [None] * m, [key] * m, range(a, a + m), [w] * m)):
                            row += v
                        size += 40 * m
                    else:
                        for row, v in zip(held, (x["h"], None, cut(a, a + m + window - 1), key, a, w)):
                            row.append(v)
                        size += len(held[2][-1])
                    if size > 4 << 20:
                        yield _batch(held)
                        held, size = [[], [], [], [], [], []], 0
            if held[0]:
                yield _batch(held)

    return rows.mapInArrow(run, _PIECE)


def _batch(held: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds)], names=["h", "g", "seg", "key", "a", "w"])


def repeated(docs: DataFrame, window: int, kind, index: Callable[[list[np.ndarray], np.ndarray, int], list[list[tuple[int, int]]]], chunk: int, crowd: int = 6000) -> DataFrame:
    """``key, spans`` of every text (by ``text_key``) with units under a window that starts anywhere else too.
    ``docs`` has ``doc_id, text``. ``index`` gets distinct segments, how often each occurs (2: more than
    once) and the window, and returns the spans of repeated windows in each."""
    rows = docs.select(text_key("text").alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), "text")
    scanned = _anchored(rows, window, kind).filter(F.size("anchors") > 0)
    texts = scanned.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.first("anchors").alias("anchors"))
    texts = cut_lineage(texts.withColumn("t", F.monotonically_increasing_id()))  # stored, so the numbers stay
    exploded = texts.select("t", "n", F.inline("anchors"))
    shared = exploded.groupBy("h").agg(F.sum(F.col("n") * F.col("c")).alias("rows"), F.count("*").alias("texts")).filter("rows > 1")
    wanted = exploded.select("t", "h", "a", "m").join(shared.select("h", (F.col("texts") > crowd).alias("hot")), "h")
    wanted = wanted.groupBy("t").agg(F.collect_list(F.struct("h", "a", "m", "hot")).alias("found"))
    wanted = texts.select("t", "key", "doc_id", "n").join(wanted, "t").drop("t")
    wanted = cut_lineage(wanted.withColumn("hot", F.exists("found", lambda x: x["hot"])))
    # Of rows with the same text only one is cut: the join is on the id too, which also spreads the copies.
    carried = packed(rows).join(wanted, ["key", "doc_id"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        weights: list[int] = []
        places: list[tuple[int, bytes, int]] = []
        size, last = 0, None

        def found() -> pa.RecordBatch | None:
            spans = index(kind.load(list(held)), np.array(weights), window)
            out = [(key, a + s, a + e) for i, key, a in places for s, e in spans[i]]
            if not out:
                return None
            kinds = [pa.binary(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["key", "s", "e"])

        for batch in batches:
            for h, seg, key, a, w in zip(*(batch.column(c).to_pylist() for c in ("h", "seg", "key", "a", "w"))):
                if h != last and size > chunk:
                    made = found()
                    if made is not None:
                        yield made
                    held, weights, places, size = {}, [], [], 0
                last = h
                i = held.setdefault(seg, len(held))
                if i == len(weights):
                    weights.append(w)
                    size += kind.size(seg)
                else:
                    weights[i] = 2
                places.append((i, key, a))
        if places:
            made = found()
            if made is not None:
                yield made

    cut = _cut(carried, window, kind)
    crowded = not wanted.filter("hot").isEmpty()
    if crowded:  # segments and windows are read apart, so the texts are sent and cut once for both
        cut = cut_lineage(cut)
    segments = cut.filter("seg is not null").drop("g")
    spans = segments.repartition("h").sortWithinPartitions("h").mapInArrow(search, "key binary, s int, e int")
    if crowded:
        windows = cut.filter("g is not null").drop("seg")
        often = windows.groupBy("h", "g").agg(F.sum("w").alias("w")).filter("w > 1").drop("w")
        spans = spans.unionByName(windows.drop("w").join(often, ["h", "g"]).select("key", F.col("a").alias("s"), (F.col("a") + window).alias("e")))
    return spans.groupBy("key").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Spans in order, joined where they overlap or touch."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(a, b) for a, b in out]


def suffix_order(first: np.ndarray, step: int, depth: int) -> np.ndarray:
    """Positions in the order of the first ``depth`` units (at least) of what follows them. ``first`` orders
    positions by their first ``step`` units; the length is doubled among those still tied."""
    n = len(first)
    order = np.argsort(first, kind="stable")
    fresh = np.concatenate([[True], first[order][1:] != first[order][:-1]])
    rank = np.empty(n, np.int64)
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = start
    slots = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    while step < depth and len(slots):
        tied = order[slots]
        after = tied + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        group = rank[tied]
        both = (group << 32) + (second + 1)
        by = np.argsort(both, kind="stable")
        tied, both = tied[by], both[by]
        order[slots] = tied
        fresh = np.concatenate([[True], both[1:] != both[:-1]])
        rank[tied] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        slots = slots[~(fresh & np.append(fresh[1:], True))]
        step *= 2
    return order


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def apply_spans(docs: DataFrame, spans: DataFrame, work: Callable[[bytes, list[tuple[int, int]]], tuple], schema: str) -> DataFrame:
    """``work`` on the bytes of every text and its merged spans; ``schema`` names what it returns after doc_id."""
    rows = docs.select(text_key("text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    joined = packed(rows).join(spans, "key", "left").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [work(t, merged(s)) for t, s in zip(unpacked(batch.column("text")), batch.column("spans").to_pylist())]
            if made:
                columns = [pa.array(c) for c in zip(*made)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *(c.split()[0] for c in schema.split(", "))])

    return joined.mapInArrow(run, f"doc_id bigint, {schema}")
