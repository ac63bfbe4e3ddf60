"""Corpus preparation: language ID, near-dedup, repeated-passage removal,
source mixing and packing, each stage written as Parquet and reread.

Every stage works on all rows its predecessor kept. Null texts, texts without
a letter and texts in no known language end at the first stage; extra columns
of ``documents``, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.llm import langid, minhash_dedup, mixing, packing, suffix_dedup
from stayline.llm.staging import staged, table


def known_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one or several known languages; noise and unlearned
    scripts go."""
    return langid.confident(docs)


def near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return minhash_dedup.one_per_group(docs, percent=80)


def cut_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur elsewhere; a document of
    which no word is left goes. n_chars follows the text."""
    left = suffix_dedup.without_repeats(docs, length=200)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left.where(mixing.word_count(F.col("text")) > 0)


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3; repeats are rows."""
    return mixing.mixed_documents(docs)


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins of 512 to 8192 words."""
    return packing.packed(docs)


STAGES = [
    ("known_language", known_language),
    ("near_dedup", near_dedup),
    ("cut_repeats", cut_repeats),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: SQL cannot express the trained language model or the packing; the stages
#: are tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
