"""Registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwatch.llm import (
    extraction, fingerprint, language, lines, mixing, negatives, packing, pii, prefixes, quality, simhash, substrings, subwords,
)
from tabwatch.session import read_table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~language.held_out()))
    scored = language.identify(docs, model)
    return scored.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read_table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(read_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(read_table(spark, sf_dir, "pages"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.dedup_lines(read_table(spark, sf_dir, "documents")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op11_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scored = subwords.judge(docs, subwords.fit(docs, labels.where(~subwords.held_out())))
    return scored.select("doc_id", subwords.held_out().alias("held_out"), "score", "predicted")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(negatives.prepared(read_table(spark, sf_dir, "embeddings")))


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixes.ordered_turns(read_table(spark, sf_dir, "conversations"))
    return prefixes.trie(prefixes.regrouped(turns)).drop("node", "parent")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_repeats": op3_repeats,
    "op4_simhash": op4_simhash,
    "op5_fingerprints": op5_fingerprints,
    "op6_pii": op6_pii,
    "op7_quality": op7_quality,
    "op8_extraction": op8_extraction,
    "op9_lines": op9_lines,
    "op10_mixing": op10_mixing,
    "op11_subwords": op11_subwords,
    "op12_negatives": op12_negatives,
    "op13_prefixes": op13_prefixes,
}
ORACLES: dict[str, str] = {"op9_lines": lines.SQL, "op12_negatives": negatives.SQL, "op13_prefixes": prefixes.SQL}
