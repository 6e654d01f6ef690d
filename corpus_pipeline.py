"""A training corpus from ``documents``, in five stages.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelmart.llm import bpe, line_dedup, mixing, quality, simhash_neardup
from reelmart.llm._common import Shared, find_package, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the best grade is one half or more stay.

    Grades come from ``labels``: 0 poor, 1 toxic, 2 good. Without any rated
    document all stay. Null texts are graded as empty ones.
    """
    find_package(spark)
    model = quality.fit(docs, quality.grades_of(table(spark, sf_dir, "labels")), grades=3)
    return quality.select(docs, model, grades=3, grade=2)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that duplicate a kept line go; documents left without words too."""
    find_package(spark)
    return line_dedup.drop_duplicate_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays (3-word shingles, 3 bits)."""
    find_package(spark)
    return simhash_neardup.drop_near_duplicates(docs, shingle=3, radius=3)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum mix: documents by training position, once per pass."""
    find_package(spark)
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of their decoding."""
    import public_tokenizers

    find_package(spark)
    out = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN, with_ids=True)
    return out.withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality_stage), ("lines", line_stage), ("simhash", simhash_stage),
          ("mix", mix_stage), ("bpe", bpe_stage)]

#: SimHash over XXH64 and BPE are not expressible in DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    shared = Shared(spark, "pipeline")
    for name, stage in STAGES:
        docs = shared.table(stage(spark, docs, sf_dir), name)
    return docs
