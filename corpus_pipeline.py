"""The corpus pipeline: five stages from ``documents`` to token counts and digests.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents``:

1. quality rules: documents that the base rule or a learned rule rejects go;
2. exact dedup: of equal texts, the document with the largest id stays;
3. SimHash near-dedup: of each group of near copies, the document with the smallest id stays;
4. mixing: each document as often as the mix takes it (none, once or twice);
5. byte-level BPE: one row per document of the mix with its token count and digests.

The learned rules, the fingerprints and the tokens have no SQL form, so ``ORACLE_SQL`` is None; the
tests hold the pipeline against a version of each stage on single rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pledgeline.llm import bpe, exact_dedup, mixing, quality_rules, simhash
from pledgeline.llm.common import shared_folder, stored
from pledgeline.llm.queries import RANKS

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.good_documents(docs, labels)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.taken_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("mixing", mixed),
    ("byte-level bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return docs
