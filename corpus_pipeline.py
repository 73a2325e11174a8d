"""A corpus in five stages: quality, exact copies, near copies, source mix, token ids.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  ``run`` writes the rows of a
stage as Parquet in the shared folder and reads them back as the next stage's documents.

* quality: documents that the classifier rejects go (labels come from the labels table).
* exact copies: of equal texts the row with the largest id stays.
* near copies: of each component of 5-word-shingle links at 0.8 the smallest id stays.
* source mix: each document is repeated as often as the mix takes its words, rounded (0, 1 or 2 times);
  documents without words leave.
* token ids: encoded and decoded again, one row for each row of the mix.

All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import bpe_chunks, exact_dedup, ngram_join, quality_qda, source_mix
from tidemill.llm.base import materialize, read_table, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_qda.keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.remix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_chunks.digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("source mix", mixture),
    ("byte-level BPE", token_ids),
]

#: The classifier and the token ids have no SQL form; tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, which stay; the tables of the other stages are deleted at the end."""
    docs = read_table(spark, sf_dir, "documents")
    with scratch(spark):
        for k, (_, stage) in enumerate(STAGES):
            docs = materialize(stage(spark, docs, sf_dir), f"stage_{k}", keep=k == len(STAGES) - 1)
    return docs
