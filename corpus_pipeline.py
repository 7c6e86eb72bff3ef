"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs. All stages but the last return
the columns of their input, whatever else these are named.

Cases, for every stage: a null text counts as empty; rows without an id pass
the first three stages by their text alone; very long texts are handled whole;
repeated rows are judged row by row until the third stage, which keeps one; an
empty table gives an empty table. Each stage's docstring says the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard, mixing, quality, toxicity
from tidemark.llm.common import apart, cut, table
from tidemark.llm.queries import encode_and_digest

#: Characters in a block of the last stage, a quarter of op4's: by then the executors' heaps are full, and their Python workers have what is left.
BLOCK_CHARS = 4_000_000


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours judge toxic go. Equal texts go or stay together; an empty text stays."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    own, back = apart(docs, "doc_id", "text")
    return toxicity.score(own, model).filter("predicted = 0").select(*back)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go; null and empty texts are among them. Equal texts go or stay together."""
    own, back = apart(docs, "text")
    return quality.judge(own).filter("kept").select(*back)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word 5-grams with a similarity of 0.8 or more stays, that of the smallest id.

    Of rows that repeat its id the one with the smallest text stays; rows
    without an id have no links and stay.
    """
    return jaccard.one_of_each(docs, n=5, threshold=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document, a row for each pass over its source. Documents of which it takes none, empty ones too, go."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed texts, as digests, and what they decode to: a row for each row, so one for each pass of a document."""
    return encode_and_digest(docs, block_chars=BLOCK_CHARS)


STAGES = [("toxicity", not_toxic), ("quality_rules", good_quality), ("ngram_jaccard", distinct_documents), ("mixing", mixed), ("byte_bpe", encoded)]

#: Toxicity, mixing and encoding can't be expressed in SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
