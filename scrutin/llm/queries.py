"""Registered queries of the training-data operators.

Each applies its operator, with production parameters, to the whole table.
ORACLES has DuckDB SQL where SQL can express the rows; the others are tested
against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from scrutin.llm import decontamination, licences, merkle, prefix_trie, urls
from scrutin.llm.common import table
from scrutin.llm.fingerprint import fingerprints
from scrutin.llm.hmm import lm_scores
from scrutin.llm.mixing import mixed
from scrutin.llm.neardup import near_duplicates
from scrutin.llm.packing import packed_digest
from scrutin.llm.pii import personal_data
from scrutin.llm.quality import quality_scores
from scrutin.llm.secrets import findings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op2_decontamination"] = decontamination.ORACLE


@query
def op3_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the id of its group (its kept document's doc_id),
    whether it is kept, its group's size and the copies of its text."""
    g = near_duplicates(table(spark, sf_dir, "documents"))
    return g.select("doc_id", g.group_doc_id.alias("class_id"), "keep", "group_size", "copies")


@query
def op5_secret_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per candidate of every document."""
    return findings(table(spark, sf_dir, "documents"))


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op7_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"))


ORACLES["op7_url_verdicts"] = urls.ORACLE


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licences(table(spark, sf_dir, "documents"))


ORACLES["op9_licences"] = licences.ORACLE


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_prefixes(table(spark, sf_dir, "conversations"))


ORACLES["op11_conversation_trie"] = prefix_trie.ORACLE


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verifications(table(spark, sf_dir, "documents"))


ORACLES["op12_merkle_manifest"] = merkle.ORACLE


@query
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
