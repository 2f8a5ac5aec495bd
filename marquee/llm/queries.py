"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from ..sources.readers import table
from . import bpe, covertree, decontam, importance, knn, langid, minhash, pii, ranked, substring, suffixdedup, tokencount, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, folder: fn(prepare(spark), folder)
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_greedy_tiling(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_tiled", "n_words", F.round("coverage", 6).alias("coverage"), F.size("tiles").alias("n_tiles"))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    return suffixdedup.remove_repeats(docs, 400).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    """
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS x FROM documents),
    w AS (SELECT rid, i, md5(hex(x[i + 1:i + 400])) AS h FROM (SELECT rid, x, unnest(range(0, octet_length(x) - 399)) AS i FROM d)),
    often AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
    hit AS (SELECT rid, i, i - row_number() OVER (PARTITION BY rid ORDER BY i) AS g FROM w SEMI JOIN often USING (h)),
    run AS (SELECT rid, min(i) AS s, max(i) + 400 AS e FROM hit GROUP BY rid, g),
    edge AS (SELECT rid, s, e, CASE WHEN s <= max(e) OVER (PARTITION BY rid ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM run),
    span AS (SELECT rid, min(s) AS s, max(e) AS e FROM (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY s) AS k FROM edge) GROUP BY rid, k),
    piece AS (SELECT rid, e AS a, lead(s) OVER (PARTITION BY rid ORDER BY s) AS b FROM (SELECT rid, s, e FROM span UNION ALL SELECT rid, -1, 0 FROM d)),
    kept AS (SELECT rid, string_agg(hex(x[a + 1:coalesce(b, octet_length(x))]), '' ORDER BY a) AS k FROM piece JOIN d USING (rid) GROUP BY rid)
    SELECT doc_id, octet_length(x)::BIGINT AS n_bytes, (octet_length(x) - len(k) // 2)::BIGINT AS n_removed,
           (SELECT count(*) FROM span WHERE span.rid = d.rid)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
    FROM d JOIN kept USING (rid)
    """
)
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_bytes(table(spark, folder, "documents"))


def repeated_words(docs: DataFrame) -> DataFrame:
    return substring.remove_repeats(docs, 35).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(
    r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x FROM documents),
    w AS (SELECT rid, i, md5(array_to_string(x[i:i + 34], ' ')) AS h FROM (SELECT rid, x, unnest(range(1, len(x) - 33)) AS i FROM d)),
    often AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
    hit AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM w SEMI JOIN often USING (h)),
    word AS (SELECT rid, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS v FROM d),
    kept AS (SELECT rid, count(*) AS n, string_agg(v, ' ' ORDER BY i) AS k FROM word ANTI JOIN hit USING (rid, i) GROUP BY rid)
    SELECT doc_id, len(x)::BIGINT AS n_words, (len(x) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (rid)
    """
)
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_words(table(spark, folder, "documents"))


def byte_bpe(docs: DataFrame) -> DataFrame:
    """Encodes and decodes whole texts; counts and digests of what comes out."""
    import public_tokenizers

    coded = bpe.encode_documents(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decode=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe(table(spark, folder, "documents"))


def language(docs: DataFrame) -> DataFrame:
    """Learns from the rows that aren't held out; the prediction reads texts alone."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.learn(docs, ~held_out)
    named = langid.identify(docs, model)
    return named.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("lang").alias("lang_pred"), "score",
        F.size("spans").alias("n_spans"),
    )


@query()
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language(table(spark, folder, "documents"))


@query()
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.token_counts(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"))


@query()
def op9_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    chain = toxicity.train(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), chain)
    return scored.select("doc_id", F.col("p_quality").alias("p_quality"), F.col("p_toxic").alias("p_toxic"), (F.col("p_toxic") >= 0.5).alias("toxic"))


@query(
    """
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
    """
)
def op10_block_knn(spark: SparkSession, folder: str) -> DataFrame:
    return knn.nearest(table(spark, folder, "embeddings"), F.pmod(F.col("vec_id"), F.lit(20)) == 0, 20)


@query()
def op3_minhash_near(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.members(table(spark, folder, "documents"))


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts and a digest of what the forms find, and all spans."""
    found = pii.extract(docs)
    kinds = F.array(*(F.lit(k) for k in pii.KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["end"])), ",")
    # A function of two parameters would get the element's place as the second, default or not.
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").alias("n_added"),
    )


@query()
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


@query(
    """
    WITH v AS (SELECT row_number() OVER () AS rid, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    p AS MATERIALIZED (SELECT a.rid AS a, b.rid AS b FROM v a JOIN v b ON a.label = b.label AND a.rid <> b.rid AND len(a.e) = len(b.e)
          WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93),
    reach AS (WITH RECURSIVE r AS (SELECT rid, rid AS at FROM v UNION SELECT r.rid, p.b FROM r JOIN p ON p.a = r.at) SELECT r.rid, min(v.vec_id) AS low FROM r JOIN v ON v.rid = r.at GROUP BY r.rid)
    SELECT v.vec_id, count(b)::BIGINT AS n_links, low AS component_id, v.vec_id = low AS kept FROM v JOIN reach USING (rid) LEFT JOIN p ON p.a = v.rid GROUP BY v.rid, v.vec_id, low
    UNION ALL
    SELECT vec_id, 0, vec_id, true FROM embeddings
    WHERE NOT coalesce(vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false)
    """
)
def op11_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, folder, "embeddings"), 0.93)


@query(
    r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS x FROM documents),
    b AS (SELECT row_number() OVER () AS iid, item_id, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS x FROM benchmark),
    q AS (SELECT iid, item_id, unnest(x) AS term FROM b),
    s AS (SELECT count(*) FILTER (len(x) > 0) AS big_n, sum(len(x))::BIGINT AS big_l FROM d),
    t AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(x) AS term FROM d) SEMI JOIN q USING (term) GROUP BY rid, term),
    w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term, big_n),
    p AS (SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(x) * big_n) // big_l))))::BIGINT AS score
          FROM q JOIN t USING (term) JOIN w USING (term) JOIN d USING (rid), s GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM p WHERE score > 0)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
    """
)
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), 10)


#: One bit of the CRC-32, eight times over, in SQL.
_STEP = "c"
for _ in range(8):
    _STEP = f"list_transform([{_STEP}], lambda c: xor(c >> 1, (c & 1) * 3988292384))[1]"


@query(
    r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM documents),
    f AS (SELECT rid, unnest(x) AS word FROM d),
    g AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
    k AS (SELECT i::UBIGINT AS i, {step} AS t FROM (SELECT i, i::BIGINT AS c FROM range(256) r(i))),
    tab AS (SELECT list(t ORDER BY i) AS t FROM k),
    c AS (SELECT word, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, len(hex(encode(word))) // 2 + 1), lambda j: ('0x' || substr(hex(encode(word)), 2 * j::INTEGER - 1, 2))::BIGINT),
                 lambda a, b: xor(a >> 8, tab.t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS bucket
          FROM (SELECT word FROM f UNION SELECT word FROM g), tab),
    sb AS (SELECT bucket, count(*) AS s FROM f JOIN c USING (word) GROUP BY bucket),
    tb AS (SELECT bucket, count(*) AS t FROM g JOIN c USING (word) GROUP BY bucket),
    gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM sb) + 10000)::DOUBLE
                    / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM tb) + 10000)::DOUBLE)))::BIGINT AS gain FROM sb LEFT JOIN tb USING (bucket)),
    w AS (SELECT rid, sum(gain)::BIGINT AS weight FROM f JOIN c USING (word) JOIN gain USING (bucket) GROUP BY rid),
    z AS (SELECT doc_id, coalesce(len(x), 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                 coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
          FROM d LEFT JOIN w USING (rid)),
    r AS (SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS n FROM z)
    SELECT doc_id, n_features, weight, score, CASE WHEN able AND n <= (SELECT 10 * count(*) FROM z WHERE n_features >= 20) // 100 THEN n END::BIGINT AS rank FROM r
    """.replace("{step}", _STEP)
)
def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    drawn = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
