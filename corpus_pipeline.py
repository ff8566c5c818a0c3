"""A corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; ``run`` writes it as
Parquet in the shared scratch folder and reads it back as the next one's docs. All
stages but the last keep the columns of documents.

Defined cases: a document whose lines have all come before, in other documents or
in itself, has nothing left and goes; one that was empty before stays a candidate for
the stages after. Of a near-duplicate group the document of the smallest id stays,
and one of those if several rows share it; a group without ids keeps one row. Null
texts count as empty in every stage. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import decontaminate, line_dedup, packing, quality, simhash
from gaugeline.llm.common import column, fresh_name, saved, table
from gaugeline.llm.queries import ENCODING

KEEP_SCORE = 0.7
SHINGLE, RADIUS = 3, 3


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    score = fresh_name(docs, "score")
    forest = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, forest, score_column=score)
    return scored.where(F.col(score) >= KEEP_SCORE).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that have come before."""
    removed = fresh_name(docs, "n_removed")
    cleaned = line_dedup.drop_repeated_lines(docs, removed_column=removed)
    emptied = (F.col(removed) > 0) & (F.trim(F.regexp_replace("text", r"\s", " ")) == "")
    kept = cleaned.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return kept.select(*map(column, docs.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.drop_near_copies(docs, shingle=SHINGLE, radius=RADIUS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens in buckets and batches."""
    return packing.pack(docs, encoding=ENCODING)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("simhash", keep_one_of_near_copies),
    ("decontaminate", drop_leaks),
    ("packing", pack),
]

# Trees, fingerprints and alignments are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
