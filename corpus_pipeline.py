"""The training-data pipeline over ``documents``: stages in order, each written as Parquet and read again.

A stage takes the documents that its predecessor kept and returns documents; the last adds token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import common, mixing, pieces, quality, secret_scan, signature_trees

#: Near duplicates: five words in a shingle, a similarity of 0.8.
NEAR = signature_trees.Shingles(size=5, percent=80)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, does not reject."""
    return quality.accepted(docs, common.table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return signature_trees.representatives(docs, NEAR)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.copies(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ids, n_tokens, and whether the ids decode to the text."""
    return pieces.checked(pieces.encode(docs, pieces.default()), pieces.default())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", encoded),
]

#: A trained classifier is beyond SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    folder = common.run_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
