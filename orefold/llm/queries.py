"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm import (
    decontaminate,
    jaccard,
    language,
    lexical,
    mixing,
    passages,
    quality,
    secrets,
    simhash,
    suffix_tree,
    tokens,
    toxicity,
    vector_codes,
)
from orefold.llm.common import documents, fold_of, with_workers


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, d: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{d}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, d), benchmark)


def op2_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return passages.passages(documents(spark, d))


def op3_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(documents(spark, d)))


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """Learns from four of five folds of the ids."""
    docs, held_out = documents(spark, d), fold_of(F.col("doc_id"), 5) == 0
    field = toxicity.fitted(docs, spark.read.parquet(f"{d}/labels.parquet"), ~held_out)
    return toxicity.scored(docs, field, {"held_out": held_out})


def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.judged(documents(spark, d))


def op6_language(spark: SparkSession, d: str) -> DataFrame:
    """Learns from three of four folds of the ids."""
    docs, held_out = documents(spark, d), fold_of(F.col("doc_id"), 4) == 2
    return language.identified(docs, language.learned(docs, ~held_out), {"held_out": held_out})


def op7_token_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encoded(documents(spark, d), tokenizer_file())


def op8_language_model(spark: SparkSession, d: str) -> DataFrame:
    """Learns from four of five folds of the ids."""
    held_out = fold_of(F.col("doc_id"), 5) == 1
    return suffix_tree.cross_scored(documents(spark, d), ~held_out, {"held_out": held_out})


def op9_source_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.digest(mixing.mixed_copies(documents(spark, d)))


def op10_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secrets.digest(secrets.secrets_in(documents(spark, d)))


def op11_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.joined(documents(spark, d))


def op12_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return lexical.ranked(documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))


def op13_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    kept = vector_codes.kept_vectors(spark.read.parquet(f"{d}/embeddings.parquet"))
    return vector_codes.digest(kept, vector_codes.learned(kept))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: with_workers(f)
    for f in (
        op1_decontamination, op2_substring_dedup, op3_simhash, op4_toxicity, op5_quality, op6_language, op7_token_ids,
        op8_language_model, op9_source_mix, op10_secrets, op11_jaccard_join, op12_lexical_search, op13_vector_codes,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op5_quality": quality.ORACLE_SQL,
    "op11_jaccard_join": jaccard.ORACLE_SQL,
    "op12_lexical_search": lexical.ORACLE_SQL,
    "op13_vector_codes": vector_codes.oracle_sql(),
}
