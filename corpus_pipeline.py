"""A training-data pipeline in five stages. Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next one's docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptmill.llm import bpe, quality, secrets, similar, simhash, winnowing
from scriptmill.runtime import Workspace, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a similarity of 0.8 or more on five-word shingles: by SimHash, verified exactly, and by prefixes where SimHash leaves similar texts apart."""
    return simhash.one_per_class(docs, find=similar.classes)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    return winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document and redacts its secrets; n_chars follows the text."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and decodes; the last stage."""
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ["doc_id"])


STAGES = [("quality classifier", quality_stage), ("simhash near-dedup", near_duplicate_stage), ("benchmark decontamination", decontamination_stage), ("secret scans", secrets_stage), ("byte-level bpe", encoding_stage)]

#: A trained classifier, a convolutional network, SimHash and BPE merges are beyond SQL; tests hold run() against a single-process version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = ws.save(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
