"""Registered queries of the numbered operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import (
    columns,
    exact_dedup,
    filter_audit,
    lm_scoring,
    mixing,
    neighbours,
    ngram_join,
    packing,
    periodic_runs,
    pii,
    quality,
    secrets,
    suffix_dedup,
    toxicity,
)


# The registered query needs some key; a real run brings its own.
EXAMPLE_KEY = b"example key of the registered query"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.annotate(_documents(spark, sf_dir))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source at least once, none more than twice, as near to the natural mix."""
    mixed = mixing.mix(_documents(spark, sf_dir), max_repeats=2.0)
    return mixed.select(
        "doc_id", "source", "n_tokens", "epoch", "block", "mix_key", "weight", "exponent"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(_documents(spark, sf_dir))
    lengths = F.transform("spans", lambda s: s["stop"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_documents(spark, sf_dir))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{secrets.KINDS[k]}")
        for k in range(3)
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.shown(F.col("base")), 256).alias("base_sha256"),
        secrets.shown(F.col("spans")).alias("spans"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(_documents(spark, sf_dir))
    return book.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~quality.passes(F.col("fail_bits"), quality.BASE_POLICY)).alias("base_failed"),
        quality.passes(F.col("fail_bits"), quality.DEFAULT_POLICY).alias("kept"),
        "fail_bits",
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = pii.pseudonymise(_documents(spark, sf_dir), key=EXAMPLE_KEY)
    shown = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    return named.select(
        "doc_id",
        F.size("spans").cast("long").alias("n_spans"),
        F.array_join(shown, ",").alias("spans"),
        "pseudo_text",
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.pack(_documents(spark, sf_dir), path, cache_words=2_000_000)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit(filter_audit.mask_cells(_documents(spark, sf_dir), labels))


def op12_embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_copies(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _tail_repeated(docs: DataFrame) -> DataFrame:
    """One document in ten, by a checksum of its id, gets a repeated tail in place of its own."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def rewritten(w: Column) -> Column:
        n, g = F.size(w), F.floor(h / 10)
        a = (g % n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        at = F.sequence(F.lit(0), n - 1)
        return F.array_join(F.transform(at, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    words = columns.words(columns.text_or_empty("text"))
    tail = columns.let(words, lambda w: F.when(F.size(w) > 0, rewritten(w)).otherwise(F.lit("")))
    return docs.select("doc_id", F.when(h % 10 == 0, tail).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_tail_repeated(_documents(spark, sf_dir)))
    shown = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(shown, lambda s: F.concat(s, F.lit("\n"))), "")
    best = found.withColumn("best", periodic_runs.strongest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_mixing": op3_mixing,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_toxicity": op6_toxicity,
    "op7_quality_rules": op7_quality_rules,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_pii": op9_pii,
    "op10_packing": op10_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_embedding_neighbours": op12_embedding_neighbours,
    "op13_periodic_runs": op13_periodic_runs,
}
