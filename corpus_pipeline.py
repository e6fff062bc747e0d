"""The corpus pipeline: quality, near-dedup, substring dedup, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result
to the shared folder and reads it back as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirewave.llm import mixing, quality, sentencepiece_bpe, simhash, substring
from hirewave.llm.common import materialize, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null texts count as empty; null metadata is a value of its own; rows that
    repeat an id are each judged by their own text.  Without labels of two
    classes every document stays.  An empty table stays empty.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id.

    Null, empty and blank texts share the fingerprint zero, so one of them
    stays; rows that repeat id and text are one, rows of one id with other
    texts are judged apart.  An empty table stays empty.
    """
    return simhash.keep_first(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document holds are taken out of the text.

    Null texts have no words and pass; texts below 13 words lose nothing; a
    document that loses all its words stays, with an empty text.
    """
    return substring.cut_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them; the last time perhaps in part.

    Null and empty texts have no words, so the mix does not take them; a null
    source is a source of its own, the last.  Ties go by seeded order, so reruns agree.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit) and the text decoded from them.

    Null texts count as empty (two ids); repeated rows come as often as they are there.
    """
    return sentencepiece_bpe.encode_decode(docs, sentencepiece_bpe.default_model()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode),
]

#: the classifier, the fingerprints and the encoder are beyond SQL; tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
