"""Training corpus from raw documents: language, quality, near duplicates, packing.

Each stage takes the documents that the one before kept, as read back from Parquet, and all but the last return the
columns of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm.bm25_packing import VOCABULARY, pack_documents
from orderloom.llm.common import settle, ship_package, table
from orderloom.llm.crf_language import label_documents, remainder
from orderloom.llm.mcd_quality import quality_rules
from orderloom.llm.ngram_jaccard import ngram_jaccard_components
from orderloom.operators.sized import broadcast_if_small

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Mean probability of the best language below which a text counts as none.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those of which no language has half the words' probability."""
    ship_package(spark)
    labelled = label_documents(docs, docs.where(remainder() != 0), COLUMNS)
    return labelled.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or lie far from their language and source."""
    ship_package(spark)
    # A verdict depends on these alone, so equal rows share it, whatever their ids.
    own = F.struct("doc_id", F.xxhash64(*(F.coalesce(F.col(c), F.lit("\0")) for c in ("text", "lang", "source"))).alias("content"))
    verdicts = quality_rules(docs.select(own.alias("doc_id"), "text", "lang", "source"))
    rejected = settle(verdicts.where("not kept").select(
        F.col("doc_id.doc_id").alias("bad_id"), F.col("doc_id.content").alias("bad_content")).distinct(), "rejected")
    marked = docs.withColumn("content", own["content"])
    return marked.join(broadcast_if_small(rejected), F.col("doc_id").eqNullSafe(F.col("bad_id"))
                       & (F.col("content") == F.col("bad_content")), "left_anti").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one with the smallest doc_id. Rows are numbered first, so repeated
    and null ids are told apart."""
    ship_package(spark)
    rows = settle(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = ngram_jaccard_components(rows.select(F.col("row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc_id"), "row")
    stay = groups.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("stay"))
    stay = settle(stay.select(F.col("stay.row").alias("row")), "stay")
    return rows.join(broadcast_if_small(stay), "row", "left_semi").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences."""
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("language_id", language_id), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", packing)]

#: The stages learn, iterate and pack; SQL cannot express them. tests/llm/test_rows_and_pipeline.py tests them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
