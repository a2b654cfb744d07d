"""From raw documents to packed training sequences: the operators of dimkeep.llm in a row.

Every stage takes all that its predecessor kept, as Parquet; all but the last
return the columns of documents. Extra columns go through; null and empty texts,
null and repeated ids are what each operator says of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeep.llm import mixing, near_duplicates, packing, quality_classifier, quality_rules
from dimkeep.llm.shared import free_name, scratch, stored, table

#: Least score of a document that stays.
GOOD = 0.3
#: Sources are mixed by this power of their sizes.
POWER = 0.5
#: Words whose ids a worker remembers, in each of two generations: its memory holds other stages' pages too.
REMEMBERED = 100_000


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches GOOD, learnt from the labels of the documents given.

    The texts are measured twice, once to learn and once to judge, rather than
    kept a second time. Without enough labels of both kinds the score is the
    share of good ones, and without any a half, so nothing goes.
    """
    known = quality_classifier.statistics(docs.filter(~quality_classifier.held_out("doc_id")))
    model = quality_classifier.fit(known, table(spark, sf_dir, "labels"))
    return docs.filter(quality_classifier.score_text(model, F.col("text")) >= GOOD)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules' votes speak for."""
    m = free_name(docs, "_measures")
    measured = stored(quality_rules.with_measures(docs, "text", m))
    model = quality_rules.learn(measured, m)
    return measured.filter(quality_rules.kept(model, m)).drop(m)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, in which the files are numbered and written."""
    m = free_name(docs, "_mix")
    mixed = mixing.mix(docs, mixing.target_weights(docs, power=POWER), out=m)
    return mixing.in_order(mixed, F.col(m)["position"]).drop(m)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4,096 tokens, numbered in the order of the mix.

    Documents are packed with their neighbours in the mix. Reading many files does not
    keep their order, so the documents are put in the order of the mix again, which
    follows from their ids and sources.
    """
    docs = mix_sources(spark, docs.select("doc_id", "text", "source"), sf_dir)
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=2, remembered=REMEMBERED)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", classify),
    ("quality rules", apply_rules),
    ("near duplicates", deduplicate),
    ("source mixing", mix_sources),
    ("packing", pack),
]

#: No stage but the rules' base can be said in SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
