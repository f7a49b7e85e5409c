"""From documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept, is written as Parquet
below the shared folder and read again by the next.  The first four return
the columns of ``documents``; the last returns the pieces of the packing.

Defined cases: a null or empty text is judged, linked and packed like any
other (it packs to its end token); texts of any length are worked on whole;
rows are chosen by row, not by id, so null and equal ids lose no other row;
copies leave one row, that of the smallest id; an empty table goes through all
stages; columns beyond those of ``documents`` go through the first four, also
those named like the stages' own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from civica.llm import qda_quality, queries, secret_scan, simhash_mih, suffix_decontam
from civica.llm.common import read_table
from civica.session import cut_lineage, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.  It learns from the
    labels of the documents at hand that aren't held out."""
    ship_package(spark)
    return qda_quality.keep_quality(docs, queries.quality_labels(spark, sf_dir), queries.QUALITY_THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component."""
    ship_package(spark)
    return simhash_mih.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is verbatim benchmark."""
    ship_package(spark)
    return suffix_decontam.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and ``n_chars``
    set to the new length."""
    ship_package(spark)
    return secret_scan.redact(docs, queries.vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in the sequences."""
    ship_package(spark)
    return queries.packed(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("pack", pack)]

#: SQL has no tokenizer, no fitted classifier and no search for a packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name=f"pipeline-{name}")
    return docs
