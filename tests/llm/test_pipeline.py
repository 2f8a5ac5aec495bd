"""The pipeline's stages on a small table, each against what its operator says about its input."""

import hashlib

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")

from marquee.llm import decontam, minhash, pii, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, written and read again."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    odd = spark.createDataFrame([(None, None, None, None, None), (9001, "", "en", "s", 0), (9001, "", "en", "s", 0), (9002, "mail a.b@example.com now", "en", "s", 24)], docs.schema)
    docs = docs.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        out[name] = (docs, spark.read.parquet(f"{folder}/{name}"))
        docs = out[name][1]
    return out


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe"]
    for name, (before, after) in stages.items():
        if name != "byte_bpe":
            assert after.dtypes == before.dtypes


def ids(df):
    return sorted(map(str, (r[0] for r in df.select("doc_id").collect())))


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    chain = toxicity.train(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scored = toxicity.score(before, chain)
    assert ids(after) == ids(scored.filter("p_toxic < 0.5")) and after.count() < before.count()


def test_one_document_of_each_class_stays(stages):
    before, after = stages["near_duplicates"]
    groups = minhash.members(before)
    wordless = before.filter(F.trim(F.coalesce("text", F.lit(""))) == "").count()
    assert after.count() == groups.filter("class_size > 1").select("class_id").distinct().count() + groups.filter("class_size = 1").count()
    assert after.filter(F.trim(F.coalesce("text", F.lit(""))) == "").count() == wordless


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    found = decontam.contaminated(before, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
    bad = {r.doc_id for r in found.collect()}
    assert bad and ids(after) == ids(before.filter(~F.coalesce(F.col("doc_id").isin(list(bad)), F.lit(False))))


def test_personal_data_is_masked(stages):
    before, after = stages["personal_data"]
    assert ids(before) == ids(after)
    for r in after.collect():
        assert r.text is None or (pii.base_spans(r.text) == [] and len(r.text) == r.n_chars)
    assert {r.text for r in after.filter("doc_id = 9002").collect()} == {"mail [EMAIL] now"}


def test_texts_are_encoded_and_decoded(stages):
    before, after = stages["byte_bpe"]
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted((str(r.doc_id), sha(r.text)) for r in before.collect()) == sorted((str(r.doc_id), r.decoded_sha256) for r in after.collect())
