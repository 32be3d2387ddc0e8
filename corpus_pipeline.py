"""A corpus pipeline over ``documents``: toxic documents go, one of each group of near copies stays,
contaminated documents go, personal data get pseudonyms, and what is left is packed into sequences.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.llm import decontaminate, jaccard, packing, pii, toxicity
from shopmarts.llm.queries import PII_KEY, table, vocabulary
from shopmarts.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Rows that pass between Spark and Python at once. Several times as much memory is held for them, on both
# sides and for every core, and whole texts are long.
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def _in_small_batches(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(*BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3 stay. The model is trained on the stage's own documents."""
    return toxicity.kept(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest id stays."""
    return jaccard.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in passages of benchmark items go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses are replaced; ``n_chars`` follows the text."""
    found = pii.pseudonymised(docs, PII_KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = F.when(F.size("pii_found") > 0, F.length("text").cast(kind))
        found = found.withColumn("n_chars", F.coalesce(new, "n_chars"))
    return found.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence of at most 1024 tokens."""
    return packing.packed(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _in_small_batches(drop_toxic)),
    ("jaccard_join", _in_small_batches(drop_near_copies)),
    ("decontaminate", _in_small_batches(drop_contaminated)),
    ("pii", _in_small_batches(pseudonymise)),
    ("packing", _in_small_batches(pack)),
]

# Learned scores, keyed hashes and token ids are not for SQL; tests/llm hold the stages against
# brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each over all that the one before it has written."""
    folder = scratch_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
