"""Each operator against a brute-force version, an exact round trip or the library it has to match, on rows with
nulls, empty and long texts, repeated rows, repeated and null ids, and columns with clashing names."""


import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import bpe, common, components, decontam, knn, langid, minhash, pii, queries, routing, substring, suffixdedup, tokencount, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, seg int"


def words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    base = [" ".join(words(rnd, rnd.randint(60, 160))) for _ in range(12)]
    texts = [*base, base[0], base[1] + " tail é", "x " + base[2], base[3][:300] + " " + base[4][200:], base[5].replace("w1 ", "q "), None, "", None, "  \t\n", "a b", "a b"]
    texts += ["ab" * 600, "ab" * 700, "word " * 300, "\n".join([base[6][:90]] * 9), "🙂 ü " * 200]
    made = [(i, t, "en", "s", None if t is None else len(t), "clash", 1) for i, t in enumerate(texts)]
    return [*made, made[1], (None, base[7], None, None, 1, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def by_rows(df):
    return Counter(tuple(r) for r in df.collect())


def sha(data):
    return hashlib.sha256(data).hexdigest()


# -- bytes and words that repeat -------------------------------------------------------------------------------


def removed(sequences, window):
    """Which places of each sequence are under a window that starts elsewhere too."""
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        cut = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                cut[i : i + window] = [True] * window
        out.append(cut)
    return out


@pytest.mark.parametrize("crowd", [6000, 0])
def test_repeated_bytes(spark, rows, docs, crowd, monkeypatch):
    monkeypatch.setattr(routing.repeated, "__defaults__", (crowd,))
    raw = [(r[1] or "").encode() for r in rows]
    want = Counter()
    for r, b, cut in zip(rows, raw, removed(raw, 100)):
        kept = bytes(x for x, c in zip(b, cut) if not c)
        spans = sum(c and (i == 0 or not cut[i - 1]) for i, c in enumerate(cut))
        want[r[0], len(b), sum(cut), spans, kept] += 1
    got = suffixdedup.remove_repeats(docs, 100)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == want


@pytest.mark.parametrize("crowd", [6000, 0])
def test_repeated_words(spark, rows, docs, crowd, monkeypatch):
    monkeypatch.setattr(routing.repeated, "__defaults__", (crowd,))
    split = [re.findall("[^\x20\x09-\x0d]+", r[1] or "") for r in rows]
    want = Counter()
    for r, s, cut in zip(rows, split, removed(split, 9)):
        want[r[0], len(s), sum(cut), " ".join(w for w, c in zip(s, cut) if not c)] += 1
    got = substring.remove_repeats(docs, 9)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept.decode()) for r in got.collect()) == want


def test_texts_are_sent_once_for_crowded_and_other_anchors(spark, docs, monkeypatch):
    made, cut = [], routing._cut
    monkeypatch.setattr(routing.repeated, "__defaults__", (1,))
    monkeypatch.setattr(routing, "_cut", lambda *a, **k: made.append(cut(*a, **k)) or made[-1])
    assert substring.remove_repeats(docs, 9).count() == docs.count()
    assert len(made) == 1


@pytest.mark.parametrize("module, kind, windows", [(suffixdedup, np.uint8, (9, 12, 40)), (substring, np.uint64, (1, 3, 7, 12))])
def test_indexes_on_random_segments(module, kind, windows):
    rnd = random.Random(5)
    for _ in range(80):
        window, letters = rnd.choice(windows), rnd.choice([2, 3, 5, 20])
        base = [[65 + rnd.randrange(letters) for _ in range(rnd.randint(1, 200))] for _ in range(3)]
        weights = Counter()
        for _ in range(rnd.randint(1, 12)):
            s = list(rnd.choice(base))
            s[rnd.randrange(len(s))] = 65 + rnd.randrange(letters)
            start = rnd.randrange(len(s))
            weights[tuple(s[start : start + rnd.randint(1, 150)])] += rnd.choice([1, 1, 2])
        segments = list(weights)
        spans = module.repeated_windows([np.array(s, kind) for s in segments], np.minimum(2, [weights[s] for s in segments]), window)
        for s, cut, found in zip(segments, _first(segments, weights, window), spans):
            mine = [False] * len(s)
            for a, b in found:
                mine[a:b] = [True] * (b - a)
            assert mine == cut


def _first(segments, weights, window):
    copies = [s for s in segments for _ in range(min(2, weights[s]))]
    cuts = dict(zip(copies, removed(copies, window)))
    return [cuts[s] for s in segments]


def test_anchors_of_equal_windows_are_equal():
    rnd = random.Random(9)
    middle = bytes(rnd.randrange(65, 70) for _ in range(500))
    texts = [bytes(rnd.randrange(65, 91) for _ in range(rnd.randint(0, 700))) + middle for _ in range(4)]
    found = []
    for t in texts:
        at = {}
        for h, a, m, _ in zip(*routing.anchors(routing.Bytes.units(t), 400, routing.Bytes)):
            at.update({i - (len(t) - 500): h for i in range(a, a + m)})
        found.append([at[i] for i in range(101)])
    assert found.count(found[0]) == 4


# -- tokens ----------------------------------------------------------------------------------------------------


def odd_texts(rnd, n):
    parts = ["a", "b", "é", "\n", "  ", "1", "x" * 50, "中", "😀", "'s", "'S", "\x1c", "é", "İ", "ß", "Ⱥ", "<|endoftext|>", "…", " ", "don't", " "]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def test_bpe_is_tiktokens(spark, rows, docs):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = queries.tokenizer_file("byte_bpe_multi_50k.tiktoken")
    coder = bpe.Ranks(path, tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=coder.rank, special_tokens={})
    texts = odd_texts(random.Random(1), 400) + ["a" * 3000, "ab" * 2000, " " * 3000, "Zusammenhänge " * 20]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids == plain.encode_ordinary(text) and coder.decode(ids).decode() == text
    want = Counter()
    for r in rows:
        ids = plain.encode_ordinary(r[1] or "")
        want[r[0], len(ids), sha(",".join(map(str, ids)).encode()), sha((r[1] or "").encode())] += 1
    assert by_rows(queries.byte_bpe(docs)) == want
    coded = bpe.encode_documents(docs, path, tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode_documents(coded, path, tokenizers.PATTERN).collect()) == Counter((r[0], r[1] or "") for r in rows)
    assert queries.byte_bpe(docs.limit(0)).collect() == []


def test_segment_tree_of_long_and_short_pieces_agree():
    pytest.importorskip("public_tokenizers")
    coder = bpe.ranks(queries.tokenizer_file("byte_bpe_multi_50k.tiktoken"), bpe.KNOWN)
    rnd = random.Random(4)
    pieces = [bytes(rnd.choice(b"aeinrst ") for _ in range(rnd.randint(2, 64))) for _ in range(200)]
    pieces = [p for p in pieces if p not in coder.rank]
    assert coder.encode_pieces(pieces) == [tuple(coder._merge_long(p)) for p in pieces]


def test_token_counts_are_the_tokenizers(spark, rows, docs):
    pytest.importorskip("public_tokenizers")
    path = queries.tokenizer_file("word_bpe_49k.json")
    library = tokencount.tokenizer(path)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for size in (4, 1000):
        got = tokencount.token_counts(docs, path, limit=100, table_size=size)
        assert by_rows(got) == Counter((r[0], len((r[1] or "").encode()), n, n > 100) for r in rows for n in [count(r[1] or "")])
    odd = odd_texts(random.Random(2), 400)
    made = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in tokencount.token_counts(made, path).collect()} == {i: count(t) for i, t in enumerate(odd)}
    assert tokencount.token_counts(docs.limit(0), path).collect() == []


# -- neighbours ------------------------------------------------------------------------------------------------


def test_nearest_is_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(1)
    vectors = [(int(i), [float(np.float32(x)) for x in rnd.normal(size=6)]) for i in range(130)]
    vectors += [(130 + i, vectors[3][1]) for i in range(40)] + [(200, [1.0, 2.0]), (201, [3.0, 1.0]), (7, vectors[7][1]), (20, vectors[20][1])]
    broken = [(300, None), (None, vectors[0][1]), (320, [0.0] * 6), (340, [float("nan")] * 6), (360, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (380, [float("inf")] * 6)]
    df = spark.createDataFrame([(a, b, 1, "x") for a, b in vectors + broken], "vec_id long, embedding array<float>, tile int, score string").repartition(4)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 4)
    monkeypatch.setattr(knn, "CANDIDATE_BLOCK", 32)
    distinct = dict(vectors)
    want = set()
    for q, v in distinct.items():
        if q % 20 == 0:
            near = sorted((-sum(np.float64(np.float32(a)) * np.float64(np.float32(b)) for a, b in zip(v, w)), c) for c, w in distinct.items() if c != q and len(w) == len(v))
            want |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(near[:20])}
    got = knn.nearest(df, F.pmod(F.col("vec_id"), F.lit(20)) == 0, 20).collect()
    assert len(got) == len(want) and {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want
    assert knn.nearest(df.limit(0), F.lit(True), 3).collect() == []


def test_nearest_with_an_id_in_many_rows(spark):
    rnd = np.random.default_rng(4)
    vectors = [(i, rnd.normal(size=6).tolist()) for i in range(120)]
    for q in (0, 40, 80):  # ids that stand more than k times among the best rows, with equal and with other vectors
        vectors += [(q + 1, (np.array(vectors[q][1]) * 3).tolist())] * 30
        vectors += [(q + 2, (np.array(vectors[q][1]) * (4 + 0.01 * i)).tolist()) for i in range(30)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(2)
    want = set()
    for q in range(0, 120, 40):
        scores = defaultdict(list)
        for c, w in vectors:
            if c != q:
                scores[c].append(sum(a * b for a, b in zip(vectors[q][1], w)))
        near = sorted((-max(s), c) for c, s in scores.items())
        want |= {(q, i + 1, c) for i, (_, c) in enumerate(near[:20])}
    got = knn.nearest(df, F.pmod(F.col("vec_id"), F.lit(40)) == 0, 20).collect()
    assert len(got) == 60 and {(r.query_id, r["rank"], r.vec_id) for r in got} == want


# -- benchmark passages ----------------------------------------------------------------------------------------


def plain_tiling(a, b, least):
    """Marks the longest common run of unmarked words, the first one in ``a``, again and again."""
    used_a, used_b, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return total
        used_a |= set(range(best[1], best[1] + best[0]))
        used_b |= set(range(best[2], best[2] + best[0]))
        total += best[0]


def test_greedy_tiling():
    rnd = random.Random(6)
    for _ in range(150):
        a = [rnd.randrange(30) for _ in range(rnd.randint(3, 30))]
        pieces = [a[i : i + rnd.randint(1, 12)] for i in (rnd.randrange(len(a)) for _ in range(4))]
        b = [x for p in pieces for x in [*p, *(rnd.randrange(30, 60) for _ in range(rnd.randint(0, 2)))]]
        found = decontam.tiles(a, [(0, b)], 3)
        assert sum(n for *_, n in found) == plain_tiling(a, b, 3)
        assert all(a[i : i + n] == b[j : j + n] for i, j, n in found)
        for side in (0, 1):
            places = [p for t in found for p in range(t[side], t[side] + t[2])]
            assert len(places) == len(set(places))


@pytest.mark.parametrize("bound", [1_000_000, 60])
def test_decontamination(spark, bound, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_WORDS", bound)
    rnd = random.Random(8)
    items = [(i, " ".join(f"b{rnd.randrange(5000)}" for _ in range(40))) for i in range(6)] + [(6, "Tiny item"), (7, None), (8, ""), (None, " ".join(f"n{i}" for i in range(20)))]
    clean = lambda n: " ".join(f"c{rnd.randrange(5000)}" for _ in range(n))
    w = items[2][1].split()
    texts = [clean(50), f"{clean(20)} {items[0][1].upper()}, {clean(9)}", f"{' '.join(w[30:])} {clean(5)} {' '.join(w[:25])}", " ".join(w[:12]) + " " + clean(30), "a tiny, item here", None, "", items[9][1], clean(9000) + " " + items[3][1]]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)] + [(1, texts[1], "c", 1), (None, texts[2], "c", 1)], "doc_id long, text string, item_id string, found int").repartition(2)
    bench = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect())
    assert got == Counter({(1, 0): 2, (2, 2): 1, (None, 2): 1, (4, 6): 1, (7, None): 1, (8, 3): 1})
    kept = decontam.contaminated(docs, bench, keep="clean")
    assert sorted(r.doc_id for r in kept.filter("clean").collect()) == [0, 3, 5, 6] and kept.columns == [*docs.columns, "clean"]
    assert decontam.contaminated(docs, bench.limit(0)).collect() == [] and decontam.contaminated(docs.limit(0), bench).collect() == []


# -- near-duplicates -------------------------------------------------------------------------------------------


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000, 1000 + i) for i in range(50)] + [(2000 + i, 2001 + i) for i in range(20)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def near_rows(rnd):
    texts = []
    for size in (2, 3, 40):
        base = words(rnd, 220, 3000)
        for _ in range(size):
            copy = list(base)
            for _ in range(2):
                copy[rnd.randrange(len(copy))] = f"new{rnd.randrange(10**6)}"
            texts.append(" ".join(copy))
    passage = words(rnd, 40, 3000)
    texts += [" ".join(words(rnd, 150, 3000) + passage) for _ in range(30)]
    texts += [None, "", "", " ", "a b c", "A  b c", "one two three four five six"] + [texts[0]] * 5
    return texts


def test_near_duplicates(spark):
    rnd = random.Random(12)
    texts = near_rows(rnd)
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)] + [(None, texts[3], 7, "x"), (0, texts[0], 7, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, sig string").repartition(3)
    shingles = []
    for _, t, *_ in rows:
        w = (t or "").lower().split()
        shingles.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in range(len(rows)):
        for b in range(a):
            both = shingles[a] & shingles[b]
            if both and len(both) >= 0.8 * len(shingles[a] | shingles[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    ids = lambda g: [rows[i][0] for i in g if rows[i][0] is not None]
    want = Counter((rows[i][0], min(ids(g)) if shingles[i] else rows[i][0], len(g) if shingles[i] else 1) for g in groups.values() for i in g)
    assert by_rows(minhash.members(docs)) == want
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert minhash.members(docs.limit(0)).collect() == [] and minhash.keep_one(docs.limit(0)).collect() == []


def test_copies_of_a_text_that_are_no_copies_of_each_other(spark):
    """A star: every copy is near the base, no two copies are near each other."""
    rnd = random.Random(8)
    base = words(rnd, 400, 100_000)
    texts = [base]
    for i in range(2000):
        copy = list(base)
        for at in rnd.sample(range(400), 7):
            copy[at] = f"c{i}x{at}"
        texts.append(copy)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    idf = minhash.document_frequencies(docs.select("text"))
    units = [minhash.words_of(" ".join(t)) for t in texts]
    near = minhash.similarities([units[0]] * 2000, units[1:], idf, 5) >= 0.8
    _, made = minhash.signatures(*minhash.weighted(units, idf, 5))
    same = (made[1:] == made[0]).reshape(-1, minhash.BANDS, minhash.ROWS)
    want = set(np.flatnonzero(near & (same.sum((1, 2)) >= minhash.AGREE) & same.all(2).any(1)) + 1)
    got = {r.doc_id for r in minhash.members(docs).filter("class_id = 0").collect()}
    assert len(want) > 1500 and want <= got


def test_samples_agree_as_often_as_texts_are_similar():
    rnd = random.Random(3)
    idf = minhash.Idf(np.zeros(0, np.uint64), np.zeros(0, np.int64), 1)
    off = []
    for _ in range(60):
        base = words(rnd, 300, 9000)
        other = list(base)
        for _ in range(rnd.randint(1, 12)):
            other[rnd.randrange(300)] = "x"
        pair = [minhash.words_of(" ".join(t)) for t in (base, other)]
        _, made = minhash.signatures(*minhash.weighted(pair, idf, 5))
        off.append((made[0] == made[1]).mean() - minhash.similarities(pair[:1], pair[1:], idf, 5)[0])
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.12


# -- personal data ---------------------------------------------------------------------------------------------


def plain_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def test_forms():
    rnd = random.Random(2)
    parts = ["a", "b.", "@", "@", "1", "2", "25", "0000", " ", "-", ".", "+", "+1 ", "(", ")", "4111111111111111", "é", "\n", "x@y.z", "1.2.3.4"]
    for _ in range(8000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("1" * 20_000 + "." + "@" * 20_000 + "a" * 20_000) == []


def test_bootstrapping_finds_what_the_forms_miss(spark):
    rnd = random.Random(5)

    def card(valid):
        while True:
            digits = "".join(rnd.choice("0123456789") for _ in range(16))
            if pii.luhn(digits) == valid:
                return digits

    texts = [f"{rnd.choice(['we', 'they'])} billed credit card {card(True)} on day {i % 7}" for i in range(40)]
    texts += ["someone billed credit card 1234123412341235 yesterday", "serial number 1234567812345678 here", "order 99999999 shipped", None, "", "mail me@x.org or call +1 (017) 555-7713 from 10.0.0.1"]
    docs = spark.createDataFrame([(i, t, "x", 1, None if t is None else len(t)) for i, t in enumerate(texts)] + [(40, texts[40], "x", 1, 9)], "doc_id long, text string, base string, found int, n_chars long").repartition(3)
    got = {r.doc_id: (r.base, r.added) for r in pii.extract(docs).collect()}
    assert [(x["kind"], x["start"], x["end"]) for x in got[40][1]] == [(2, 27, 43)] and not got[41][1] and not got[42][1]
    assert all([tuple(x) for x in got[i][0]] == plain_spans(t or "") for i, t in enumerate(texts))
    masked = {r.doc_id: (r.text, r.n_chars) for r in pii.mask(docs).collect()}
    assert masked[40][0] == "someone billed credit card [CARD] yesterday" and masked[40][1] == len(masked[40][0])
    assert masked[41][0] == texts[41] and masked[43] == (None, None) and masked[44][0] == ""
    assert masked[45][0] == "mail [EMAIL] or call [PHONE] from [IP]" and pii.mask(docs).columns == docs.columns
    out = {r.doc_id: r for r in queries.personal_data(docs).collect()}
    assert out[45].base_sha256 == sha(out[45].spans.encode()) and out[40].spans == "card:27:43" and out[40].base_sha256 == sha(b"")
    assert pii.extract(docs.limit(0)).collect() == [] and pii.mask(docs.limit(0)).collect() == []


def test_personal_data_is_counted_by_kind(spark):
    texts = ["a@b.org c@d.org", "10.0.0.1 or +1 (017) 555-7713", "a@b.org 10.0.0.1 4111111111111111 +1 (017) 555-7713 +1 (017) 555-7714", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for r in queries.personal_data(docs).collect():
        spans = plain_spans(texts[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in spans) for kind in range(4)]
        assert r.base_sha256 == sha(",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans).encode())


def test_bootstrapping_finds_other_notations_by_their_context(spark):
    rnd = random.Random(6)
    texts = [f"please call +49 30 {rnd.randrange(10**6, 10**7)} today" for _ in range(200)]
    local = ["(030) 1234567", "030/7654321", "0171 5557713"]
    texts += [f"please call {n} today" for n in local] + [f"item {n} sold" for n in ("030/7654322", "(030) 1234569")] + ["please call 12345 today"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    added = {r.doc_id: [tuple(x) for x in r.added] for r in pii.extract(docs).collect()}
    assert all(added[200 + i] == [(3, 12, 12 + len(n))] for i, n in enumerate(local))
    assert not any(added[i] for i in (203, 204, 205))


# -- language and toxicity -------------------------------------------------------------------------------------

FOLDER = "/root/testdata/sf0.01"


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(3)
    lengths = np.array([5, 0, 1, 7, 3])
    scores = rnd.normal(size=(lengths.sum(), 3)).astype(np.float32)
    labels, start = langid.viterbi(scores, lengths, 0.7), 0
    for n in lengths:
        best = max((sum(scores[start + i, (p // 3**i) % 3] for i in range(n)) - 0.7 * sum((p // 3**i) % 3 != (p // 3 ** (i + 1)) % 3 for i in range(n - 1)), p) for p in range(3**n)) if n else (0, 0)
        assert list(labels[start : start + n]) == [(best[1] // 3**i) % 3 for i in range(n)]
        start += n


def test_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = queries.language(docs).join(docs.select("doc_id", F.col("lang").alias("true")), "doc_id").filter("held_out").collect()
    assert len(got) > 100 and sum(r.lang_pred == r.true for r in got) >= 0.97 * len(got)
    model = langid.learn(docs, F.lit(True))
    de, fr = (max((r.text for r in docs.filter(F.col("lang") == x).limit(20).collect()), key=len)[:400] for x in ("de", "fr"))
    odd = spark.createDataFrame([(1, f"{de}\n{fr}"), (2, None), (3, "12 34 ..."), (4, ""), (5, "日本語"), (None, de), (6, fr), (6, fr)], "doc_id long, text string").withColumn("spans", F.lit(1))
    out = defaultdict(list)
    for r in langid.identify(odd, model).collect():
        out[r.doc_id].append(r)
    spans = out[1][0].spans
    assert [s.lang for s in spans] == ["de", "fr"] and abs(spans[1].start - len(de)) < 30 and spans[-1].end == len(de) + 1 + len(fr)
    assert [out[i][0].lang for i in (2, 3, 4)] == ["und"] * 3 and out[5][0].lang in model.langs and out[None][0].lang == "de" and len(out[6]) == 2
    nothing = langid.learn(docs, F.lit(False))
    assert {r.lang for r in langid.identify(odd, nothing).collect()} == {"und"} and langid.identify(odd.limit(0), model).collect() == []


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64(F.col("doc_id") + 1), F.lit(4))
    chain = toxicity.train(docs, labels.filter(half > 0))
    assert len(chain["models"]) == 2 and len(chain["models"][1]) == len(chain["models"][0]) + 1
    scored = toxicity.score(docs, chain)
    assert scored.columns == [*docs.columns, "p_quality", "p_toxic"]
    held = scored.join(labels.filter(half == 0), "doc_id").select("toxic", "p_toxic").collect()
    yes, no = [r.p_toxic for r in held if r.toxic], [r.p_toxic for r in held if not r.toxic]
    assert len(yes) > 60 and np.mean(np.array(yes) >= 0.5) > 0.8 and np.mean(np.array(no) >= 0.5) < 0.01


def test_toxicity_without_much_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b", 1), (2, None, 1), (3, "", 1), (None, "c d", 1), (1, "a b", 1)], "doc_id long, text string, words int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.p_toxic < 0.01 for r in toxicity.score(docs, toxicity.train(docs, none)).collect())
    one = spark.createDataFrame([(1, 1, 0), (3, None, 0), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, one)).collect()
    assert len(got) == 5 and all(r.p_toxic < 0.01 for r in got) and toxicity.score(docs.limit(0), toxicity.train(docs, one)).collect() == []


def test_out_of_fold_chain():
    rnd = random.Random(4)
    rows, labels = [], []
    for _ in range(400):
        first = rnd.random() < 0.5
        rows.append(["ugly" if first and rnd.random() < 0.9 else "fine", f"noise{rnd.randrange(50)}"])
        labels.append([float(first), float(first)])
    chain = toxicity.fit_chain(rows, labels, [i % 5 for i in range(400)])
    width = len(chain["words"])
    assert "ugly" in chain["words"] and chain["models"][1][width] > 0.5  # the second category leans on the first


def test_plain_classes_are_the_unicode_ones():
    regex = pytest.importorskip("regex")
    for code in range(0x180):
        c = chr(code)
        if not common.NOT_PLAIN(c):
            for inside, pattern in ((common.LETTER, r"\p{L}"), (common.NUMBER, r"\p{N}"), (common.SPACE, r"\s")):
                assert bool(re.fullmatch(f"[{inside}]", c)) == bool(regex.fullmatch(pattern, c)), hex(code)


def test_bpe_holds_few_pieces_at_a_time():
    import tracemalloc

    import public_tokenizers as tokenizers

    coder = bpe.Ranks(queries.tokenizer_file("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    texts = ["one two " * 12_500] * 60  # 6 MB
    tracemalloc.start()
    ids = coder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ids) == 60 and len({tuple(x) for x in ids}) == 1 and coder.decode(ids[0]).decode() == texts[0]
    assert peak < 50e6


def test_workers_let_go_of_what_other_steps_have_kept(spark, docs):
    tokenizers = pytest.importorskip("public_tokenizers")
    path = queries.tokenizer_file("byte_bpe_multi_50k.tiktoken")

    def kept(batch):
        import pyarrow as pa

        n = bpe.ranks.cache_info().currsize if hasattr(bpe.ranks, "cache_info") else len(common._KEPT)
        return pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    spread = docs.repartition(16, F.rand(1))
    bpe.encode_documents(spread, path, tokenizers.PATTERN).collect()
    assert {r.n for r in common.per_batch(spread, kept, "n bigint").collect()} == {0}
    coder = bpe.ranks(path, tokenizers.PATTERN)
    common.let_go(("bpe", path, tokenizers.PATTERN))
    assert bpe.ranks(path, tokenizers.PATTERN) is coder
    common.let_go()
    assert bpe.ranks(path, tokenizers.PATTERN) is not coder


def test_bpe_texts_are_held_as_packed_ids():
    import tracemalloc

    tokenizers = pytest.importorskip("public_tokenizers")
    coder = bpe.Ranks(queries.tokenizer_file("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    texts = ["".join(f" {i}x{k}" for i in range(2_000)) for k in range(40)]
    tracemalloc.start()
    coded = coder.coded(texts)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert [len(x) // 4 for x in coded] == [len(x) for x in coder.encode(texts)] and {bytes(v) for v in coder.cache.values()}
    assert held < 6 * sum(map(len, coded))


def test_powers_are_as_many_as_the_texts_need():
    small, large = routing._Powers(), routing._Powers()
    want = large(100_000)
    assert len(small(10)[0]) == 10 and len(small.up) <= 1 << 12
    for n in (5_000, 20, 100_000):
        assert all((a == b[:n]).all() for a, b in zip(small(n), want))
    assert len(small.down) <= 200_000
