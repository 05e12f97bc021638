"""Training-data pipeline over ``documents``: five stages, each one of the operators in llm/.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept; the first four return the columns of documents, the last one the
encoded texts.  No stage can be left out or reordered without changing what the
later ones see, so they are plain functions over DataFrames.

Defined results of all stages: null and empty texts are texts without words;
other columns pass through as they are, whatever their names; rows that share a
doc_id are rows of their own; an empty table gives an empty table; texts are
read whole, however long.  What else a stage does with such rows is said there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.op2_suffix_dedup import without_repeats
from llm.op5_quality_rules import good_documents
from llm.op6_ngram_jaccard_join import distinct_documents
from llm.op7_sentencepiece import encode_texts
from llm.op8_decontamination import clean_documents
from llm.storage import saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised quality rules keep.

    Null, empty and wordless texts fail the base rule on length and go; equal
    texts get one verdict, whatever their doc_id, a null one included.
    """
    return good_documents(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates: five-word shingles, similarity 0.8.

    Texts without words are in no group and stay; of rows with equal doc_id and
    text one stays; null doc_ids come after all others.
    """
    return distinct_documents(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that occur earlier; none goes as a whole.

    Characters that a cut divides go too.  A null text stays null, null doc_ids
    come after all others, and n_chars follows the text that is left.
    """
    return without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; those without words hold none and stay."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with digests of the ids and of the text they decode to; null is the empty text, one end id."""
    return encode_texts(docs, keep_texts=False).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: expectation-maximisation and BPE can't be stated in SQL; tests/llm/ compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, in order, over the documents table; each reads the files that the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, saved(docs) if k else docs, sf_dir)
    return docs
