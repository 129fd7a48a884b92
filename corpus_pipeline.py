"""Corpus pipeline: five stages from raw documents to packed sequences.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next stage's documents.  All stages but the last
return the columns of ``documents``:

1. quality classifier: importance resampling; rejected documents go;
2. line dedup: repeated lines stay in their smallest document only;
3. n-gram Jaccard join: one document of each group of near copies (five-word
   shingles, similarity of 0.8 or more) stays;
4. substring dedup: repeated passages stay in their smallest document only;
5. best-fit packing of the tokenized texts into sequences.

``n_chars`` follows the text where a stage changes it.  SQL cannot express stage
1 (model fitting), 4 and 5, so ``ORACLE_SQL`` is None; tests/llm holds every
stage against a brute-force version."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotide.llm.common import table, written
from velotide.llm.importance import Selection
from velotide.llm.line_dedup import line_dedup
from velotide.llm.packing import pack_documents
from velotide.llm.paragraph_dedup import paragraph_dedup
from velotide.llm.parity_join import jaccard_components

TOKENIZER = "byte_bpe_50k.json"
SHINGLE, PERCENT = 5, 80


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return Selection(docs, table(spark, sf_dir, "labels")).select(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(line_dedup(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each component stays.  A group's others are found by
    id, so the texts join a slim table of the ids to drop."""
    found = jaccard_components(docs, SHINGLE, PERCENT)
    dropped = written(found.filter("doc_id <> component_id").select("doc_id").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(paragraph_dedup(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substring_dedup),
    ("best-fit packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
