"""Registered queries of the operators for training data, and their DuckDB oracles.

Every query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from curata.llm import hashing, language, licences, middle, neardup, packing, personal, pivots, quality, rules, sharding, tokens, trie
from curata.llm.common import read

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def pieces(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, VOCABULARY)


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(read(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.digests(read(spark, sf_dir, "documents"), VOCABULARY)


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    machines = language.fit(docs)
    return (language.predict(docs, machines)
            .select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


@query
def op5_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = personal.scan(docs, personal.fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == personal.KINDS.index(kind))).cast("long")
    return found.select(F.col("k").alias("doc_id"), *[count(kind).alias(f"n_{kind}") for kind in personal.BASE],
                        F.sha2(personal.listed(F.col("base")), 256).alias("base_sha256"), personal.listed(F.col("spans")).alias("spans"))


@query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = licences.scan(docs, licences.inverse_frequencies(docs))
    return found.select(F.col("k").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
                        "base_labels", "labels", "score")


ORACLES["op6_licences"] = licences.oracle()


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), percent=85)


ORACLES["op8_minhash"] = neardup.oracle(85)


@query
def op7_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(read(spark, sf_dir, "embeddings"))


ORACLES["op7_pivots"] = pivots.oracle()


@query
def op4_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashing.nearest(read(spark, sf_dir, "embeddings"))


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(read(spark, sf_dir, "documents"))


ORACLES["op2_sharding"] = sharding.oracle()


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of texts labelled good and not toxic."""
    return read(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))


@query
def op11_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = middle.transform(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


ORACLES["op11_middle"] = middle.oracle()


@query
def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(trie.rebuilt(trie.conversations(read(spark, sf_dir, "conversations"))))


ORACLES["op13_trie"] = trie.oracle()


@query
def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
