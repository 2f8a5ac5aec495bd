"""The corpus pipeline: toxic documents out, one document of each group of near-duplicates, contaminated
documents out, personal data masked, texts encoded.

All stages take null and repeated ids, null, empty and very long texts, further columns of any name that doesn't begin
with ``_chain_``, ``_near_`` or ``_pii_`` and isn't ``_clean``, and empty tables, for which they give an empty result;
without labelled documents nothing counts as toxic. Null and empty texts are near nothing and not contaminated: if the
first stage keeps them, they stay to the end and have no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm import decontam, minhash, pii, toxicity
from marquee.llm.queries import byte_bpe
from marquee.session import cut_lineage, prepare
from marquee.sources.readers import table

#: The stages have no common SQL: two are learned models and one is a randomised search.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose probability of being toxic is below one half. The chain learns from the
    labelled documents of the table it is given. Repeated rows share their fate; a probability of exactly one half goes."""
    prepare(spark)
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, chain, prefix="_chain_")
    return scored.filter("_chain_toxic < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, the one with the least id (null first). Texts without
    words are in no class."""
    prepare(spark)
    return minhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no benchmark item. An empty benchmark keeps all."""
    prepare(spark)
    flagged = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"), keep="_clean")
    return flagged.filter("_clean").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; keeps every document. Null texts stay null."""
    prepare(spark)
    return pii.mask(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as counts and digests, and of what they decode to."""
    prepare(spark)
    return byte_bpe(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each reads what the one before has written to the shared folder."""
    docs = table(prepare(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
