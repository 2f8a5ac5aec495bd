"""Near-duplicate documents by improved consistent weighted sampling.

A shingle of five words weighs its count in the document times the mean inverse document frequency of its words.
Document frequencies are counted over all documents; words in fewer than one document in a thousand weigh the
same, so only the words above that share need a table, and of those there are at most a thousand times the words
of an average document. Each of 40 samples picks a shingle and a level so that two documents agree with the
probability of their weighted Jaccard similarity. Ten bands of four samples bring candidates together.

The documents of a band are compared in four steps, each of which leaves out pairs that are in one class by then:
with one document of the band, for each document the one it agrees with most first; with the others of these; in
bands of many documents with the one that has got the most links, which is the one that its copies differ least from;
and at last all with all. In bands of few documents that gives the pairs that agree in enough samples and are in
different classes. In bands of many, blocks of whole documents are compared, and only as many links come back as join
their classes. Every pair is verified with the exact weighted Jaccard similarity of whole texts, so each pair that
shares a band and agrees often enough is verified or in one class already. Links found later join the classes
found before; these are not searched anew.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_and_text, let_go, packed, per_batch, slices, text_key, unpacked
from .components import components, forest
from .routing import Words, mix

BANDS, ROWS = 10, 4
SAMPLES = BANDS * ROWS
#: Samples that must agree before a pair is verified: at a similarity of 0.8, one pair in 1,400 has fewer.
AGREE = 24
#: Share of the documents above which a word has a weight of its own.
FREQUENT = 0.001
#: Bands with more documents are first compared with their most linked one.
MANY = 64
#: Documents of a band in a block, blocks that a task holds at a time, and shingles multiplied at a time.
BLOCK, HELD, COLUMNS = 512, 4, 4096
#: Bytes of compressed texts that are unpacked at a time.
PRESSED = 1 << 18
_RANDOM = np.random.default_rng(11)
_LEVEL = _RANDOM.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
_LOG_C = np.log(_RANDOM.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
_SALT = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_C = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> np.ndarray:
    return Words.units((text or "").lower().encode())


class Idf:
    """Inverse document frequencies between 1 and 2: 2 for words at or below the frequent share."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n_docs: int):
        order = np.argsort(words)
        self.words = words[order]
        top = math.log(1 / FREQUENT)
        self.values = (1 + np.clip(np.log(max(n_docs, 1) / np.maximum(counts[order], 1)) / top, 0, 1)).astype(np.float32)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(words), 2, np.float32)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.values[at], np.float32(2))


def counted(texts: list[np.ndarray], idf: Idf, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document number, shingle, inverse document frequency and count, in the order of the first two; a text with
    fewer than ``size`` words has one shingle, a text without words none."""
    lengths = np.array([len(t) for t in texts], np.int64)
    words = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64)
    weight = np.concatenate([[0], np.cumsum(idf(words), dtype=np.float64)])
    firsts = np.cumsum(lengths) - lengths
    long = np.flatnonzero(lengths >= size)
    count = lengths[long] - size + 1
    doc = np.repeat(long, count)
    at = np.repeat(firsts[long], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    h = np.zeros(len(at), np.uint64)
    for i in range(size):
        h = (h ^ (h >> np.uint64(31))) * _C + words[at + i]
    mean = (weight[at + size] - weight[at]) / size
    short = np.flatnonzero((lengths > 0) & (lengths < size))
    if len(short):
        one = [np.uint64(len(texts[i])) for i in short]
        for k, i in enumerate(short):
            for w in texts[i]:
                with np.errstate(over="ignore"):
                    one[k] = (one[k] ^ (one[k] >> np.uint64(31))) * _C + w
        doc, h = np.concatenate([doc, short]), np.concatenate([h, np.array(one, np.uint64)])
        mean = np.concatenate([mean, (weight[firsts[short] + lengths[short]] - weight[firsts[short]]) / lengths[short]])
    order = np.lexsort((h, doc))
    doc, h, mean = doc[order], mix(h[order]), mean[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]))
    times = np.diff(np.append(first, len(doc)))
    return doc[first], h[first], mean[first], times


def weighted(texts: list[np.ndarray], idf: Idf, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, shingle and weight."""
    doc, shingle, mean, times = counted(texts, idf, size)
    return doc, shingle, (mean * times).astype(np.float32)


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents that have shingles and their samples, one row each."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros((0, SAMPLES), np.int32)
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    sizes = np.diff(np.append(starts, len(doc)))
    log_w = np.log(weight)
    out = np.empty((len(starts), SAMPLES), np.int32)
    for k in range(SAMPLES):
        h = mix(shingle ^ _SALT[k])
        r = _LEVEL[(h & np.uint64(0xFFFF)).astype(np.int64)]
        beta = ((h >> np.uint64(40)).astype(np.float32)) * np.float32(2.0**-24)
        level = np.floor(log_w / r + beta)
        value = _LOG_C[((h >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)] - r * (level - beta + 1)
        hits = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, starts), sizes))
        chosen = hits[np.searchsorted(hits, starts)]
        picked = mix(shingle[chosen] + level[chosen].astype(np.int64).view(np.uint64) * _C)
        out[:, k] = (picked >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return doc[starts], out


def similarities(left: list[np.ndarray], right: list[np.ndarray], idf: Idf, size: int) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts."""
    doc, shingle, weight = weighted([t for pair in zip(left, right) for t in pair], idf, size)
    pair = doc // 2
    order = np.lexsort((shingle, pair))
    pair, shingle, weight = pair[order], shingle[order], weight[order].astype(np.float64)
    again = np.concatenate([(pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1]), [False]]) if len(pair) else np.zeros(0, bool)
    at = np.flatnonzero(again)
    low = np.bincount(pair[at], np.minimum(weight[at], weight[at + 1]), minlength=len(left))
    total = np.bincount(pair, weight, minlength=len(left))
    return low / np.maximum(total - low, 1e-300)


def document_frequencies(rows: DataFrame) -> Idf:
    """Counts over all rows; partitions count on their own first, and only words above the share come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        docs = 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            words, counts = (np.concatenate(x) for x in zip(*held))
            words, at = np.unique(words, return_inverse=True)
            return words, np.bincount(at, counts).astype(np.int64)

        for batch in batches:
            texts = batch.column("text").to_pylist()
            docs += len(texts)
            for part in slices(texts):
                rows = [words_of(t) for t in texts[part]]
                words = np.concatenate(rows)
                doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
                order = np.argsort(words, kind="stable")
                words, doc = words[order], doc[order]
                fresh = np.concatenate([[True], words[1:] != words[:-1]]) if len(words) else np.zeros(0, bool)
                new = fresh | np.concatenate([[True], doc[1:] != doc[:-1]]) if len(words) else fresh
                starts = np.flatnonzero(fresh)
                held.append((words[starts], np.add.reduceat(new.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)))
            if len(held) > 8:  # words that slices share are held once
                held[:] = [summed()]
        if docs:
            words, counts = summed()
            for start in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(words[start : start + (1 << 16)].view(np.int64)), pa.array(counts[start : start + (1 << 16)])], names=["word", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([docs], pa.int64())], names=["word", "n"])
        held.clear()
        let_go()

    counted = cut_lineage(rows.select("text").mapInArrow(count, "word bigint, n bigint"))
    n_docs = counted.filter("word is null").agg(F.sum("n")).first()[0] or 0
    # At most the distinct words of an average document divided by the share.
    often = counted.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") > FREQUENT * n_docs).toArrow()
    return Idf(often.column("word").to_numpy().view(np.uint64), often.column("n").to_numpy(), n_docs)


def classes(docs: DataFrame, threshold: float = 0.8, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, doc_id, class_key`` for every row: rows with equal ``class_key`` are near-duplicates of each
    other, directly or through others; ``key`` stands for the whole text (``text_key``).

    Words are in lower case and split at white space. Rows with the same text always share a class, but texts
    without words (null and empty ones among them) are never linked: each distinct one is a class that ``members`` takes apart. Rows
    with null ids take part; extra columns are not read; an empty table gives an empty result.
    """
    rows = id_and_text(docs, id_col, text_col).select(text_key("text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    idf = docs.sparkSession.sparkContext.broadcast(document_frequencies(rows))

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        made: list[list[int] | None] = [None] * len(texts)
        for part in slices(texts):
            doc, out = signatures(*weighted([words_of(t) for t in texts[part]], idf.value, size))
            for i, row in zip(doc.tolist(), out.tolist()):
                made[part.start + i] = row
        return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("doc_id"), pa.array(made, pa.list_(pa.int32()))], names=["key", "doc_id", "sig"])

    signed = cut_lineage(per_batch(rows, sign, "key binary, doc_id bigint, sig array<int>"))
    known = cut_lineage(signed.filter("sig is not null").groupBy("key").agg(F.min(F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("pick"), F.first("sig").alias("sig")))

    parts = F.array(*(F.xxhash64(F.lit(b), *(F.col("sig")[b * ROWS + r] for r in range(ROWS))) for b in range(BANDS)))
    bands = known.select(F.explode(parts).alias("band"), "key")
    turn = F.struct(F.xxhash64("band", "key").alias("o"), "key")
    hubs = bands.groupBy("band").agg(F.count("*").alias("n"), F.min(turn)["key"].alias("hub")).filter("n > 1")
    bands = cut_lineage(bands.join(hubs, "band"))

    def agreeing(pairs: DataFrame) -> DataFrame:
        """Pairs whose samples agree often enough, each once, with how often."""
        side = lambda c: known.select(F.col("key").alias(c), F.col("sig").alias(f"sig_{c}"))
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        agree = F.size(F.filter(F.zip_with("sig_a", "sig_b", lambda p, q: p == q), lambda e: e))
        return both.select("a", "b", agree.alias("agree")).filter(F.col("agree") >= AGREE)

    pairs = cut_lineage(agreeing(bands.filter("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b"))))
    ends = bands.select("key").distinct().join(known.select("key", "pick"), "key")
    # The texts that share a band with another one, one row of each.
    texts = cut_lineage(packed(rows).withColumn("pick", F.coalesce("doc_id", F.lit(-(1 << 63)))).join(ends, ["key", "pick"]).select("key", "text"))

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides, score = [batch.column(c) for c in ("text_a", "text_b")], []
        for part in slices(sides[0].to_pylist(), PRESSED):
            left, right = ([words_of(t.decode()) for t in unpacked(c[part])] for c in sides)
            score.append(similarities(left, right, idf.value, size))
        good = pa.array(np.concatenate(score) >= threshold)
        return pa.RecordBatch.from_arrays([batch.column("a").filter(good), batch.column("b").filter(good)], names=["a", "b"])

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda c: texts.select(F.col("key").alias(c), F.col("text").alias(f"text_{c}"))
        return cut_lineage(per_batch(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b"), verify, "a binary, b binary"))

    def in_class(pairs: DataFrame, of: DataFrame, ends: tuple[str, ...] = ("a", "b")) -> DataFrame:
        """``pairs`` with the roots of their ends."""
        for c in ends:
            pairs = pairs.join(of.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
        return pairs

    best = pairs.groupBy("a").agg(F.max(F.struct("agree", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    links = verified(best)
    # Each document under the one it was linked with, and that one under its own: most of a class is together by then.
    one = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    two = one.join(one.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    rest = in_class(pairs.select("a", "b").join(best, ["a", "b"], "left_anti"), cut_lineage(two)).filter("root_a <> root_b")
    links = cut_lineage(links.unionByName(verified(rest)))
    found = components(links)

    def merged(found: DataFrame, more: DataFrame) -> DataFrame:
        """The classes after links between them."""
        joined = components(in_class(more, found).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
        moved = in_class(found.withColumnRenamed("root", "a"), joined, ("a",)).select("node", F.col("root_a").alias("root"))
        return cut_lineage(moved.unionByName(joined))

    def split(members: DataFrame) -> DataFrame:
        """The members of bands that hold several classes."""
        named = in_class(members.withColumnRenamed("key", "a"), found, ("a",)).select("band", "n", "hub", F.col("a").alias("key"), F.col("root_a").alias("root"))
        several = named.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("band")
        return cut_lineage(named.join(several, "band"))

    live = split(bands)
    degree = links.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("links"))
    crowded = live.filter(F.col("n") > MANY)
    linked = crowded.filter("key <> hub").join(degree, "key")
    top = linked.groupBy("band").agg(F.max(F.struct("links", F.xxhash64("band", "key").alias("o"), "key", "root")).alias("m")).select("band", F.col("m.key").alias("b"), F.col("m.root").alias("root_b"))
    second = agreeing(crowded.join(top, "band").filter("root <> root_b").select(F.col("key").alias("a"), "b"))
    pairs = cut_lineage(second.unionByName(agreeing(few_pairs(live.filter(F.col("n") <= MANY), known))).select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"))
    found = merged(found, verified(pairs))
    live = split(crowded.drop("root"))
    if not live.isEmpty():
        found = merged(found, cut_lineage(joined_in_blocks(live.join(texts, "key"), idf, threshold, size)))
    named = signed.join(found.withColumnRenamed("node", "key"), "key", "left")
    return named.select("key", "doc_id", F.when(F.col("sig").isNotNull(), F.coalesce("root", "key")).alias("class_key"))


def few_pairs(members: DataFrame, known: DataFrame) -> DataFrame:
    """``a, b``: the documents of each band (``MANY`` at most) in different classes that agree in enough samples.
    ``members`` has ``band, key, root``."""
    sent = members.join(known.select("key", "sig"), "key").select("band", "key", "root", "sig")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        held: list[tuple[np.ndarray, ...]] = []
        band = None

        def pairs() -> pa.RecordBatch | None:
            keys, roots, sigs = (np.concatenate(x) for x in zip(*held))
            agree = (sigs[:, None, :] == sigs).sum(2)
            i, j = np.nonzero((agree >= AGREE) & (roots[:, None] != roots))
            i, j = i[i < j], j[i < j]
            if len(i):
                return pa.RecordBatch.from_arrays([pa.array(keys[i], pa.binary()), pa.array(keys[j], pa.binary())], names=["a", "b"])

        for batch in batches:
            bands = batch.column("band").to_numpy()
            keys, roots = (np.array(batch.column(c).to_pylist(), object) for c in ("key", "root"))
            sigs = batch.column("sig").flatten().to_numpy().reshape(-1, SAMPLES)
            cuts = [0, *(np.flatnonzero(np.diff(bands)) + 1).tolist(), len(bands)]
            for a, b in zip(cuts, cuts[1:]):
                if bands[a] != band:
                    made = pairs() if held else None
                    if made is not None:
                        yield made
                    band, held = bands[a], []
                held.append((keys[a:b], roots[a:b], sigs[a:b]))
        made = pairs() if held else None
        if made is not None:
            yield made

    return sent.repartition("band").sortWithinPartitions("band").mapInArrow(work, "a binary, b binary")


class _Documents:
    """Some documents of a band with their shingles; one that stands several times in a document is several."""

    def __init__(self, roots: np.ndarray, texts: list[bytes], idf: Idf, size: int):
        self.roots = roots
        doc, shingle, mean, times = counted([words_of(t.decode()) for t in texts], idf, size)
        self.total = np.bincount(doc, mean * times, minlength=len(texts))
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        self.doc, self.weight = np.repeat(doc, times), np.repeat(mean, times)
        self.shingle = mix(np.repeat(shingle, times) + nth.astype(np.uint64) * _C)

    def part(self, shingles: np.ndarray, values: np.ndarray | None) -> np.ndarray:
        at = np.minimum(np.searchsorted(shingles, self.shingle), len(shingles) - 1)
        hit = np.flatnonzero(shingles[at] == self.shingle)
        out = np.zeros((len(self.roots), len(shingles)))
        out[self.doc[hit], at[hit]] = 1 if values is None else values[hit]
        return out

    def near(self, other: _Documents, threshold: float) -> np.ndarray:
        """Which documents of both sides have at least this weighted Jaccard similarity."""
        both = np.intersect1d(self.shingle, other.shingle)
        low = np.zeros((len(self.roots), len(other.roots)))
        for start in range(0, len(both), COLUMNS):
            some = both[start : start + COLUMNS]
            low += self.part(some, self.weight) @ other.part(some, None).T
        return low >= threshold * (self.total[:, None] + other.total - low)


def joined_in_blocks(members: DataFrame, idf, threshold: float, size: int) -> DataFrame:
    """``a, b``: links that join the classes (by their roots) of near documents of each band, as few as do.
    ``members`` has ``band, n, key, root, text``, the texts compressed. The documents of a band are dealt over blocks;
    a task holds some of them and compares them with each other and with a stream of those in later blocks."""
    block = F.pmod(F.xxhash64(F.lit(1), "key"), F.ceil(F.col("n") / BLOCK)).cast("int")
    sent = members.withColumn("block", block).withColumn("turn", F.floor(F.col("block") / HELD).cast("int"))
    sent = sent.withColumn("at", F.explode(F.sequence(F.lit(0), "turn"))).select("band", "at", (F.col("turn") > F.col("at")).alias("later"), "block", "root", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        group = block = None
        held: list[_Documents] = []
        rows: list[tuple[bytes, bytes]] = []

        def compared(later: bool) -> pa.RecordBatch | None:
            """The rows of one block with those held; the block is held from then on, if it belongs to them."""
            mine = _Documents(np.array([r for r, _ in rows], object), unpacked(pa.array([t for _, t in rows])), idf.value, size)
            if not later:
                held.append(mine)
            ends: list[tuple[np.ndarray, np.ndarray]] = []
            for other in held:
                i, j = np.nonzero(mine.near(other, threshold) & (mine.roots[:, None] != other.roots))
                ends.append((mine.roots[i], other.roots[j]))
            a, b = (np.concatenate(x) for x in zip(*ends)) if ends else ([], [])
            if not len(a):
                return None
            roots, number = np.unique(np.concatenate([a, b]), return_inverse=True)
            least = forest(len(roots), number[: len(a)], number[len(a) :])
            bound = np.flatnonzero(least != np.arange(len(least)))
            return pa.RecordBatch.from_arrays([pa.array(roots[bound], pa.binary()), pa.array(roots[least[bound]], pa.binary())], names=["a", "b"])

        later = False
        for batch in batches:
            for band, at, is_later, nth, root, text in zip(*(batch.column(c).to_pylist() for c in ("band", "at", "later", "block", "root", "text"))):
                if ((band, at), nth) != (group, block):
                    made = compared(later) if rows else None
                    if made is not None:
                        yield made
                    if (band, at) != group:
                        held.clear()
                    group, block, later = (band, at), nth, is_later
                    rows.clear()
                rows.append((root, text))
        made = compared(later) if rows else None
        if made is not None:
            yield made

    return sent.repartition("band", "at").sortWithinPartitions("band", "at", "later", "block").mapInArrow(work, "a binary, b binary")


def members(docs: DataFrame, threshold: float = 0.8, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, class_size`` for every row; the class id is the least document id of its class.
    Rows without words are classes of their own. See ``classes`` for what counts as a word and a class."""
    rows = cut_lineage(classes(docs, threshold, size, id_col, text_col))
    sums = rows.filter("class_key is not null").groupBy("class_key").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(sums, "class_key", "left").select("doc_id", F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"))


def keep_one(docs: DataFrame, threshold: float = 0.8, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input without all but one row of each class: the one with the least document id (null first), of
    repeated rows any. Rows without words stay. All columns are kept; none may be called ``_near_``-anything."""
    rows = cut_lineage(classes(docs, threshold, size, id_col, text_col))
    first = rows.filter("class_key is not null").groupBy("class_key").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"), "key")).alias("m"))
    same = rows.groupBy("key", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i")).agg(F.count("*").alias("n"), F.first("class_key").isNull().alias("wordless"))
    stay = same.join(first.select(F.col("m.key").alias("key"), F.col("m.i").alias("i"), F.lit(True).alias("first")), ["key", "i"], "left")
    stay = stay.filter("first or wordless").select(F.col("key").alias("_near_key"), F.col("i").alias("_near_id"), (F.col("n") > 1).alias("_near_again"), F.col("wordless").alias("_near_none"))
    marked = docs.withColumns({"_near_key": text_key(F.col(text_col).cast("string")), "_near_id": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))})
    kept = marked.join(stay, ["_near_key", "_near_id"])
    once = kept.filter("not _near_again or _near_none").select(*docs.columns)
    again = kept.filter("_near_again and not _near_none").dropDuplicates(["_near_key", "_near_id"]).select(*docs.columns)
    return once.unionByName(again)
