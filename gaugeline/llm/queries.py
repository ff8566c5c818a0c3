"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    alignment,
    decontaminate,
    lattice_lm,
    line_dedup,
    nearest,
    packing,
    passages,
    periodic_runs,
    quality,
    simhash,
    token_store,
    toxicity,
    url_filter,
)
from gaugeline.llm.common import saved, table
from gaugeline.llm.oracles import LINE_DEDUP_SQL, url_filter_sql
from gaugeline.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = url_filter.UrlRules(
    rules=(
        ("block", "net/"),
        ("allow", "example.net/en/"),
        ("block", "example.com/de/"),
        ("allow", "org/fr/"),
    ),
    weights=url_filter.with_digits(
        [
            *((term, url_filter.LIMIT) for term in url_filter.STRICT_TERMS),
            *((term, url_filter.LIMIT / url_filter.SOFT_LIMIT) for term in url_filter.SOFT_TERMS),
            *((term, url_filter.WEAK_WEIGHT) for term in url_filter.WEAK_TERMS),
        ]
    ),
)


def op1_token_store(spark: SparkSession, directory: str) -> DataFrame:
    path = scratch_dir(spark, "token-store")
    token_store.write_tokens(
        table(spark, directory, "documents"),
        path,
        tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
        end_id=2,
    )
    return token_store.document_digests(token_store.read_segments(spark, path))


def op2_lattice_lm(spark: SparkSession, directory: str) -> DataFrame:
    vocabulary = lattice_lm.Vocabulary.of(public_tokenizers.path("piece_bpe_32k.model"))
    return lattice_lm.score_texts(table(spark, directory, "documents"), vocabulary)


def op3_quality(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    forest = quality.fit_quality(docs, table(spark, directory, "labels"))
    return quality.score_quality(docs, forest).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op4_passages(spark: SparkSession, directory: str) -> DataFrame:
    return passages.repeated_passages(table(spark, directory, "documents"))


def op5_decontaminate(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, directory, "benchmark"))


def op6_line_dedup(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(
        docs, lines_column="n_lines", removed_column="n_removed"
    )


def op7_url_filter(spark: SparkSession, directory: str) -> DataFrame:
    judged = url_filter.judge_urls(table(spark, directory, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


# The pattern and ranks of one vocabulary, and the same in a library for long stretches.
ENCODING = {
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
    "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
}


def op8_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(table(spark, directory, "documents"), encoding=ENCODING)


def op9_nearest(spark: SparkSession, directory: str) -> DataFrame:
    return nearest.nearest(table(spark, directory, "embeddings"), k=5, query_every=50)


def op10_simhash(spark: SparkSession, directory: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, directory, "documents"), shingle=3, radius=3)
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return groups.select("doc_id", fingerprint, "component_id")


def op11_alignment(spark: SparkSession, directory: str) -> DataFrame:
    aligned = alignment.align_tokens(
        table(spark, directory, "documents"),
        byte_level=public_tokenizers.path("byte_bpe_50k.json"),
        pieces=public_tokenizers.path("piece_bpe_32k.model"),
        pattern=public_tokenizers.PATTERN,
    )
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = saved(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    width = len(alignment.Pieces(public_tokenizers.path("piece_bpe_32k.model")).bytes_of)
    counts = alignment.link_counts(aligned, width)
    return aligned.join(counts, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"),
        "groups_sha256",
    )


def op12_periodic_runs(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    planted = periodic_runs.with_planted_runs(docs, id_column="doc_id", text_column="text")
    found = periodic_runs.with_runs(planted)
    # Runs come by start, then by period, so the first of equal ones stays.
    best = F.expr(
        """CASE WHEN size(runs) > 0 THEN aggregate(runs, runs[0],
             (a, r) -> if(r.length * a.period > a.length * r.period, r, a)) END"""
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ended = F.transform(lines, lambda line: F.concat(line, F.lit("\n")))
    rows = found.select("*", best.alias("best"), F.array_join(ended, "").alias("listed"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    docs = table(spark, directory, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, directory, "labels"))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Query] = {
    "op1_token_store": op1_token_store,
    "op2_lattice_lm": op2_lattice_lm,
    "op3_quality": op3_quality,
    "op4_passages": op4_passages,
    "op5_decontaminate": op5_decontaminate,
    "op6_line_dedup": op6_line_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_packing": op8_packing,
    "op9_nearest": op9_nearest,
    "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_toxicity": op13_toxicity,
}
ORACLES: dict[str, str] = {
    "op6_line_dedup": LINE_DEDUP_SQL,
    "op7_url_filter": url_filter_sql(URL_RULES),
}
