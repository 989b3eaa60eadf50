"""A training-data pipeline of five stages over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import exact_dedup, mixing, ngram_join, packing, quality
from blotter.llm.columns import ref
from blotter.plans.guards import materialise

# Production parameters, the same as those of the single queries.
MAX_REPEATS = 2.0
TOKENIZER = "word_bpe_49k.json"

# Packing of byte-pair ids and hashing into signatures have no SQL form; tests
# hold run() against a brute-force version instead.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy."""
    return quality.keep_passing(docs)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text."""
    return exact_dedup.keep_distinct(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near copies."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at least once, small ones again up to the repetition limit."""
    return mixing.mix(docs, max_repeats=MAX_REPEATS).select(*[ref(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with a checksum of each."""
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", distinct_texts),
    ("ngram_jaccard_join", near_duplicates),
    ("mix_sources", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")[0]
    return STAGES[-1][1](spark, docs, sf_dir)
