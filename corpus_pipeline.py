"""A training corpus from documents: filter, deduplicate, decontaminate, mix, store as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each
one's rows as Parquet in the shared folder and reads them as the next one's docs.
All stages but the last keep the columns of documents; the mix's rows are the
blocks it takes, with ids in the order of output shards.

Defined results: a null text counts as empty in every stage (it is scored, is alike
to other wordless ones, holds no test item, has no words to mix); rows without id
or with equal ids are documents like others, of which near-dedup keeps one for
each class, an id once; ties go to the least id; very long texts are handled whole;
an empty table gives no rows; extra columns are kept by the first three stages and
dropped by the mix, whose blocks are no documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerostrata.llm import bagminhash, decontam, mixing, quality, tokenstore
from aerostrata.llm.common import stage_path, table

#: Words of a block that the mix deals out.
BLOCK_WORDS = 512


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return bagminhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of the sources' words, as the target weights ask for them."""
    return mixing.mix_blocks(docs, block_words=BLOCK_WORDS)


def token_store(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token store holds of each block, read back from its files."""
    return tokenstore.store_and_read(docs, stage_path(spark, "token-store"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_store),
]

#: Classifier, signatures and tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = stage_path(spark, name.split()[0].lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
