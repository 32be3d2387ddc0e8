"""The operators of this subpackage over the given tables, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.llm import (
    ann,
    decontaminate,
    jaccard,
    langid,
    ngram_lm,
    oracle,
    packing,
    pii,
    prefix_trie,
    repair,
    simhash,
    spelling,
    toxicity,
    warc,
)
from shopmarts.llm.shipping import shipped
from shopmarts.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(os.path.join(folder, f"{name}.parquet"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    documents, items = (table(spark, folder, name) for name in ("documents", "benchmark"))
    return decontaminate.contamination(documents, items)


def op2_kmeans_tree(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    queries = vectors.where("vec_id % 20 = 0")
    return ann.search(ann.build(vectors, queries, k=20), queries, k=20)


def op3_repair_ids(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_dir(spark, "repair")
    path = vocabulary("word_bpe_49k.json")
    manifest = repair.write_shards(table(spark, folder, "documents"), files, path)
    return repair.stored_documents(spark, files, manifest)


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), files)
    return warc.read_archives(spark, files).drop("url")


# Who has this key can undo the pseudonyms: a deployment passes its own.
PII_KEY = "an example key"


def op5_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.pseudonymised(table(spark, folder, "documents"), PII_KEY)
    return found.select("doc_id", "text", F.size("pii_found").alias("n_replaced"))


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    return toxicity.scored(documents, toxicity.train(documents, labels))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return langid.identified(documents, langid.train(documents))


def op9_stupid_backoff(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_lm.scored(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"))


def op10_cost_balanced_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    return packing.packed(table(spark, folder, "documents"), path)


def op11_spelling_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.counted_words(table(spark, folder, "documents")))


def op12_simhash_bktree(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    sequences = prefix_trie.turn_sequences(table(spark, folder, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.branched(sequences))


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_kmeans_tree": op2_kmeans_tree,
    "op3_repair_ids": op3_repair_ids,
    "op4_warc": op4_warc,
    "op5_pii_pseudonyms": op5_pii_pseudonyms,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_toxicity": op7_toxicity,
    "op8_language": op8_language,
    "op9_stupid_backoff": op9_stupid_backoff,
    "op10_cost_balanced_packing": op10_cost_balanced_packing,
    "op11_spelling_tiles": op11_spelling_tiles,
    "op12_simhash_bktree": op12_simhash_bktree,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {
    "op1_decontaminate": oracle.OP1,
    "op4_warc": oracle.OP4,
    "op6_jaccard_join": oracle.OP6,
    "op9_stupid_backoff": oracle.OP9,
    "op11_spelling_tiles": oracle.OP11,
    "op13_prefix_trie": oracle.OP13,
}
