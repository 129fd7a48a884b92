"""Registered queries that use a tokenizer or a trained model."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from velotide.llm.common import table
from velotide.llm.importance import importance_resampling
from velotide.llm.packing import pack_documents
from velotide.llm.toxicity import toxicity
from velotide.llm.word_table import encode_decode

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"


def op8_word_bpe(spark, sf_dir):
    out = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op7_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_importance_resampling(spark, sf_dir):
    return importance_resampling(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op7_toxicity": op7_toxicity, "op9_importance_resampling": op9_importance_resampling, "op6_best_fit_packing": op6_best_fit_packing, "op8_word_bpe": op8_word_bpe}
ORACLE = {}
