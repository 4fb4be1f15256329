"""Corpus pipeline: documents to token ids, in stages that each keep what the next one works on.

All stages but the last return the columns they are given, whatever others there are beside doc_id, text and
source.  What they do with nulls, empty texts, ties, equal rows and empty tables is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, ngram_join, source_mix, token_output, toxic_crf
from tidemark.llm.runtime import Stored


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts stay, rows with one id are judged each by its own text, and an empty table stays empty.
    """
    return toxic_crf.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: of ties that with the smallest id, a null id last; of equal rows one.

    Texts without words (null, empty, blank) are no duplicates of each other and all stay; an empty table stays empty.
    """
    return ngram_join.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go.

    Null and empty texts stay, rows with one id are judged each by its own text, and an empty table stays empty.
    """
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, copies as equal rows.

    Texts without words are never taken; null is a source; rows with one id and sizes of equally many binary digits in one
    source are taken together; an empty table stays empty.
    """
    return source_mix.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, written and read back: doc_id, start, n_tokens, ids_crc32.

    A row for each row, also of equal ones: null ids come first, null and empty texts are an end id alone, and an empty
    table gives no rows.
    """
    return token_output.token_store(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: A trained model and a tokenizer decide what comes out: no SQL expresses that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = Stored(spark).put(f"stage-{name}", stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
