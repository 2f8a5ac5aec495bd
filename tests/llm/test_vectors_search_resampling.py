"""Near-duplicate vectors, ranked search and importance resampling against brute-force versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from marquee.llm import components, covertree, importance, ranked, terms

LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def texts():
    rnd = random.Random(5)
    made = [" ".join(rnd.choice(["Alpha", "beta", "GAMMA", "état", "漢字", "x1", "rare%d" % rnd.randrange(50)]) for _ in range(rnd.randint(0, 60))) for _ in range(70)]
    return [*made, made[3], made[3], None, "", " ,;\n", "É-É_É", "z" * 200, "beta " * 30_000 + "rare7"]


DOCS = "doc_id long, text string, term string, rank int, score double, block long, place long"


@pytest.fixture(scope="module")
def rows():
    made = [(i * 7 - 90, t, "clash", 1, 1.0, 2, 3) for i, t in enumerate(texts())]
    return [*made, made[5], (None, made[6][1], None, None, None, None, None), (None, None, None, None, None, None, None), (-(1 << 63), made[7][1], "", 0, 0.0, 0, 0)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.mark.parametrize("piece", [1 << 20, 40])
@pytest.mark.parametrize("longest", [1, 3])
def test_features_of_texts_in_one_piece_and_in_many(monkeypatch, piece, longest):
    monkeypatch.setattr(terms, "PIECE", piece)
    some = [*texts()[:-1], "beta " * 300]
    want = Counter()
    for i, t in enumerate(some):
        w = words_of(t)
        want.update((i, zlib.crc32(" ".join(w[k : k + n]).encode()) % 10_000) for n in range(1, longest + 1) for k in range(len(w) - n + 1))
    got = Counter()
    for number, bucket in importance.buckets_of([None if t is None else t.encode() for t in some], longest):
        got.update(zip(number.tolist(), bucket.tolist()))
    assert got == want


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_equals_brute_force(spark, rows, docs, longest):
    target = ["alpha beta x1", None, "", "état rare3 rare4"]
    runs = lambda t: [" ".join(w[k : k + n]) for w in [words_of(t)] for n in range(1, longest + 1) for k in range(len(w) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % 500
    s = Counter(bucket(f) for r in rows for f in runs(r[1]))
    t = Counter(bucket(f) for x in target for f in runs(x))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 500) / ((s[b] + 1) * (t.total() + 500)))) for b in s}
    want = []
    for r in rows:
        found = runs(r[1])
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        want.append([r[0], len(words_of(r[1])), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((w for w in want if w[1] >= 5), key=lambda w: (-w[4], w[0] is None, w[0] or 0))
    for i, w in enumerate(able[: 40 * len(able) // 100]):
        w[5] = i + 1
    target_rows = spark.createDataFrame([(x,) for x in target], "text string")
    got = importance.resample(docs, target_rows, percent=40, min_words=5, longest=longest, buckets=500, seed=7)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want))


def test_resampling_of_an_empty_table_and_towards_an_empty_target(spark, docs):
    empty = docs.limit(0)
    assert importance.resample(empty, docs).collect() == []
    assert importance.resample(docs, empty).count() == docs.count()


@pytest.mark.parametrize("blocks", [1 << 20, 7])
def test_radix_ranks(spark, monkeypatch, blocks):
    monkeypatch.setattr(importance, "BLOCK", blocks)
    rnd = random.Random(2)
    made = [(rnd.choice([None, *range(-5, 5), (1 << 63) - 1, -(1 << 63), rnd.randrange(1 << 40)]), rnd.choice([0, 7, -7, rnd.randrange(-(1 << 45), 1 << 45)])) for _ in range(300)]
    got = importance.radix_ranked(spark.createDataFrame(made, "doc_id long, score long").repartition(5)).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 301))
    order = [(-r.score, r.doc_id is None, r.doc_id or 0) for r in sorted(got, key=lambda r: r["rank"])]
    last = (1 << 63) - 1  # the largest id and no id are one key
    assert [(s, last if n else i) for s, n, i in order] == sorted((-s, last if i is None else i) for i, s in made)


def brute_search(rows, items, k):
    docs = [(r[0], Counter(words_of(r[1]))) for r in rows]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        found = []
        for doc_id, c in docs:
            score = 0
            for t in set(words_of(text)) & set(c):
                m = 10 + 90 * c.total() * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(found)[:k])]
    return Counter(out)


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, rows, docs, monkeypatch, small):
    if small:  # many blocks, several passes
        for name, value in (("POSTINGS", 30), ("DOCUMENTS", 9), ("MAX_TERMS", 6)):
            monkeypatch.setattr(ranked, name, value)
    items = [(1, "alpha"), (2, "Alpha BETA gamma état rare1 rare2 rare3"), (2, "rare7 rare7"), (3, None), (4, ""), (5, "absent"), (None, "漢字 x1 beta"), (6, "É rare9 absent z")]
    frame = spark.createDataFrame([(*i, "clash", 0) for i in items], "item_id long, text string, doc_id string, score int")
    got = ranked.search(docs, frame, 4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute_search(rows, items, 4)
    assert ranked.search(docs.limit(0), frame).collect() == [] and ranked.search(docs, frame.limit(0)).collect() == []


@pytest.mark.parametrize("short", [0.0, 0.125, 2.0])
def test_search_by_accumulators_by_documents_and_by_both(short, monkeypatch):
    """One block, with lists so long that skipping matters."""
    monkeypatch.setattr(ranked, "SHORT", short)
    monkeypatch.setattr(ranked, "STEP", 16)
    rng = np.random.default_rng(4)
    n = 3000
    postings = [np.sort(rng.choice(n, size, replace=False)) for size in (3, 40, 200, 1500, 2900)]
    times = [rng.integers(1, 9, len(p)) for p in postings]
    raw = lambda x, kind=np.uint32: np.asarray(x).astype(kind).tobytes()
    sizes = np.cumsum([0, *map(len, postings)])
    row = {"ids": rng.permutation(n).tolist(), "lengths": raw(rng.integers(5, 90, n), np.int64), "terms": raw(range(5)), "starts": raw(sizes[:-1]), "places": raw(np.concatenate(postings)), "times": raw(np.concatenate(times))}
    block = ranked._Block(row, n, 47 * n)
    for wanted in ([0, 1, 2, 3, 4], [3, 4], [0, 4], [2]):
        weights = np.array([7000, 4000, 2700, 700, 30])[wanted]
        total = np.zeros(n, np.int64)
        for t, w in zip(wanted, weights):
            s = slice(sizes[t], sizes[t + 1])
            total[block.places[s]] += w * block.bases[s]
        best = ranked.Best(10)
        ranked.look_up(block, np.array(wanted), weights, best)
        want = sorted((-s, i) for s, i in zip(total.tolist(), row["ids"]) if s > 0)[:10]
        assert [(s, i) for s, _, i in best.rows] == want


# -- vectors ---------------------------------------------------------------------------------------------------


def linked(rows, least):
    able = [i for i, (vec_id, v, label) in enumerate(rows) if vec_id is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    groups = defaultdict(list)
    for i in able:
        groups[rows[i][2], len(rows[i][1])].append(i)
    root = {i: i for i in able}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for own in groups.values():
        m = np.array([rows[i][1] for i in own])
        m /= np.sqrt((m**2).sum(1))[:, None]
        near = m @ m.T >= least
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near)):
            links[own[a]] += 1
            root[find(own[a])] = find(own[b])
    low = {}
    for i in able:
        low[find(i)] = min(low.get(find(i), rows[i][0]), rows[i][0])
    return Counter((r[0], links[i], low[find(i)] if i in root else r[0], i not in root or low[find(i)] == r[0]) for i, r in enumerate(rows))


def vectors():
    rng = np.random.default_rng(1)
    made = []
    for label, n in (("a", 600), ("b", 150), (None, 20), ("c", 1)):
        base = rng.normal(size=(max(1, n // 8), 8))
        for k in range(n):
            b = base[rng.integers(len(base))] if k % 3 else base[0]
            made.append((len(made) - 50, (b + rng.normal(size=8) * rng.choice([0, 0.02, 0.1, 0.3, 1]) * np.linalg.norm(b) / 3).tolist(), label))
    copy = made[3][1]
    made += [(900, copy, "a")] * 5 + [(901, [0.0] * 8, "a"), (902, None, "a"), (903, [None] * 8, "a"), (904, [math.nan] * 8, "a"), (905, [math.inf] * 8, "a")]
    return made + [(None, copy, "a"), (906, copy[:5], "a"), (907, [], "a"), (908, [1.0, 2.0], "a"), (909, [2.0, 4.0], "a"), (910, copy, "b"), (900, made[4][1], "a")]


@pytest.mark.parametrize("small", [False, True])
def test_vectors_equal_brute_force(spark, monkeypatch, small):
    if small:  # several blocks in a cell, several groups of blocks, many cells
        for name, value in (("BLOCK", 40), ("HELD", 2), ("PER_CENTRE", 20), ("SHARE", 100)):
            monkeypatch.setattr(covertree, name, value)
    rows = vectors()
    frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "vec_id long, embedding array<double>, label string, node string, cell int, weight int")
    got = covertree.near_duplicates(frame.repartition(5), 0.93)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == linked(rows, 0.93)


def test_no_vectors(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_trees_of_two_blocks_count_every_link(monkeypatch):
    rng = np.random.default_rng(6)

    def tree(raw, part):
        order, sizes, above = covertree.nested(covertree.unit(raw))
        raw = raw[order]
        for n, radius, up in zip(sizes, covertree.RADII, above):
            apart = covertree.distances(covertree.unit(raw), covertree.unit(raw))
            far = apart[:n, :n][~np.eye(n, dtype=bool)]
            assert apart[:, :n].min(1).max() <= radius + 1e-7 and (not len(far) or far.min() > radius or radius == 2.0)
            assert (up[:n] == np.arange(n)).all()
        row = {"label": "", "dim": raw.shape[1], "cell": 0, "part": part, "joined": None, "weights": np.ones(len(raw), np.int64).tobytes(), "vectors": raw.tobytes()}
        row |= {"nodes": np.array([b"%08d" % i for i in range(len(raw))], "S24").tobytes(), "sizes": np.array(sizes, np.int32).tobytes()}
        row |= {"above": np.concatenate(above[:-1]).astype(np.int32).tobytes(), "radii": np.concatenate(covertree.reaches(covertree.unit(raw), sizes, above[:-1])).tobytes()}
        return covertree.Tree(row)

    for spread in (0.01, 0.1, 0.3, 2):
        base = rng.normal(size=(5, 16))
        a, b = (tree(base[rng.integers(5, size=n)] + rng.normal(size=(n, 16)) * spread, k) for k, n in enumerate((150, 90)))
        first, second, left, right = covertree.traverse(a, b, 0.93)
        near = a.points @ b.points.T >= 0.93
        assert (first == near.sum(1)).all() and (second == near.sum(0)).all()
        every, few = (components.forest(240, x, y + 150) for x, y in ((*np.nonzero(near),), (left, right)))
        assert (every == few).all()
