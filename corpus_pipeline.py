"""A training corpus from raw documents: five stages over the table ``documents``.

Each stage takes what its predecessor kept, written as Parquet and read again.

* language ID: documents without a known language, or with a low share of one, go,
* SimHash near-dedup: one document of each group of near copies stays,
* benchmark decontamination: documents that hold a benchmark item go,
* mixing: documents are taken as often as their source's target weight asks for,
* token ids: the mix is encoded and written in blocks; the result is its index.

Defined results: documents with a null or empty text, or without a letter, have no known
language and go; a null id is its own: such documents are never duplicates of one another, and
stay; rows that repeat an id are one document, the first by its text; ties in language go to
the first by name, and of a group the least id stays; a null source is a source. Texts of any
length are read whole. Extra columns pass through every stage but the last, whatever their
names. Where nothing can be learned (an empty table, no language given) all documents pass the
first stage; an empty table gives an empty index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm import decontaminate, language, mixing, simhash, tokens
from orefold.llm.common import documents, fold_of, stored, with_workers
from orefold.llm.queries import tokenizer_file


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, language.learned(docs, fold_of(F.col("doc_id"), 4) != 2))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.encoded(docs, tokenizer_file())


#: Buffers on both sides of the pipe to a worker hold a few times as much, and stages follow one
#: another in the same executors.
STAGE_BATCH_BYTES = 4 * 1024 * 1024

STAGES = [
    ("language_id", with_workers(language_id, STAGE_BATCH_BYTES)),
    ("near_dedup", with_workers(near_dedup, STAGE_BATCH_BYTES)),
    ("decontamination", with_workers(decontamination, STAGE_BATCH_BYTES)),
    ("mix", with_workers(mix, STAGE_BATCH_BYTES)),
    ("token_ids", with_workers(token_ids, STAGE_BATCH_BYTES)),
]

#: Trained models, hashes and the tokenizer have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


QUERIES = {"pipeline": run}
