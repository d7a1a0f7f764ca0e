"""From raw to training documents in five stages, each an operator of ``tallybook.llm`` over all that the one before kept.

1. toxicity: documents that the factorization machine scores 0.5 or more go.
2. near duplicates: one document of each group stays, the one with the smallest id (five-word shingles, similarity 0.8).
3. decontamination: passages of benchmark items are cut out; documents that mostly consist of them go.
4. secrets: spans are replaced by a mark; no document goes.
5. mixing: each document is taken as often as the mix asks for.

All but the last return the columns of ``documents``. Every stage is written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import decontaminate, mixing, ngram_join, secrets, toxicity
from tallybook.llm.tables import documents, stored

SHINGLE_WORDS, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, documents(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, SHINGLE_WORDS, PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_hits(docs, documents(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_copies),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: The trained stages can't be expressed in SQL. ``tests/llm`` holds what each stage keeps against a plain version of its rule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
