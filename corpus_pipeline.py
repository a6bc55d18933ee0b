"""A training corpus from raw documents: each stage reads what its predecessor wrote.

All stages but the last keep the columns of the documents (names, types, order; extra columns too). Null texts have no
language, so the first stage takes them out; null ids, repeated rows and empty tables pass as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flightlake.llm import feistel, langid, packing
from flightlake.llm.decontaminate import drop_contaminated
from flightlake.llm.queries import DEMO_KEY, tokenizer_path
from flightlake.llm.simhash_trie import keep_one
from flightlake.session import scratch_path, scratch_scope


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or unlike every language learned from the documents' own labels, go.

    Unlike is a cosine under the bound learned from each language's own documents, for texts of that length.
    """
    return langid.drop_unidentified(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: that with the smallest doc_id."""
    return keep_one(docs, shingle_words=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of a test item's five-word shingles go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text is replaced; a pseudonym has the length of what it stands for."""
    return feistel.replace_pii(docs, DEMO_KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs, tokenizer_path(), sequence=1024)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pseudonyms", pseudonyms),
    ("pack", pack),
]

# The stages hold trained models, XXH64 fingerprints and a tokenizer, which SQL cannot express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    What a stage wrote on its way is deleted once its result is written; the results are left to the caller.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
