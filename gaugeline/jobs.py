"""The jobs of a deployment: ingest, submissions, reports and compaction."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.config import Settings
from gaugeline.functions.rules import RuleSet
from gaugeline.operators.submit import accepted_events, rejected_submissions, validate_submissions
from gaugeline.plans import reports, summaries
from gaugeline.schemas import (
    CONSUMPTION_ZONE,
    CURATED_ZONE,
    RAW_ZONE,
    REFUSED_ZONE,
    REJECTED_ZONE,
)
from gaugeline.session import scratch_dir
from gaugeline.sinks.compaction import compact_offsets, compact_zone
from gaugeline.sinks.publish import publish
from gaugeline.sinks.reports import Report, publish_reports
from gaugeline.sinks.zones import write_zone
from gaugeline.sources.lake import read_curated, register_curated_view
from gaugeline.sources.messages import KafkaSource
from gaugeline.streaming.ingest import IngestJob, drain, supervise

REPORTS = (
    Report("top_anomaly_hours", "Hours with most anomalies", reports.top_anomaly_hours),
    Report("sensor_statistics", "Sensors in figures", reports.sensor_statistics),
    Report("temperature_daily_evolution", "Temperature by day", reports.daily_evolution),
    Report("partition_pruning", "Rows in all and in one partition", reports.partition_counts),
)

# Bounds the first batches of a large topic.
OFFSETS_PER_TRIGGER = 10_000_000


def ingest(
    spark: SparkSession,
    settings: Settings,
    *,
    messages: DataFrame | None = None,
    once: bool = False,
    shared_batches: bool = False,
    trigger_interval: str = "10 seconds",
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = OFFSETS_PER_TRIGGER,
    **options,
) -> None:
    """Fill the zones from the topic, until stopped or until it is drained.

    ``options`` are those of ``IngestJob``: rules, window, watermark,
    max_future_skew, window_future_limit, plain_layout, label.
    """
    if not settings.lake_root or not settings.checkpoint_root:
        raise ValueError("lake_root and checkpoint_root must name shared folders")
    if messages is None:
        source = KafkaSource.from_settings(
            settings,
            min_partitions=min_partitions,
            max_offsets_per_trigger=max_offsets_per_trigger,
        )
        messages = source.stream(spark)
    job = IngestJob(
        settings.lake_root,
        settings.checkpoint_root,
        trigger_interval=None if once else trigger_interval,
        **options,
    )
    queries = job.start(messages, shared_batches=shared_batches)
    if once:
        drain(queries)
    else:
        supervise(spark, queries)


def submit(
    submissions: DataFrame,
    settings: Settings,
    *,
    write_id: str,
    received_day: date,
    received_ms: int,
    rules: RuleSet | None = None,
    send: Callable[[DataFrame, Settings], None] = publish,
) -> None:
    """Validate submitted bodies; publish the accepted, store the refused.

    The refused go first and replace those of an earlier try of the same write;
    messages already sent are sent again, as the topic is at least once.
    """
    if not settings.lake_root:
        raise ValueError("lake_root must name a shared folder")
    spark = submissions.sparkSession
    answered = validate_submissions(submissions, rules, received_ms=f"{received_ms}L")
    # Stored once: a source that grows meanwhile would give refused and accepted bodies of
    # two different sets.
    path = scratch_dir(spark, "answered")
    answered.write.parquet(path)
    answered = spark.read.schema(answered.schema).parquet(path)
    refused = rejected_submissions(answered).withColumn(
        "received_day", F.lit(received_day.isoformat())
    )
    write_zone(refused, settings.lake_root, REFUSED_ZONE, write_id=write_id, rerun=True)
    send(accepted_events(answered), settings)


def write_reports(spark: SparkSession, settings: Settings, output_dir: str) -> dict[str, str]:
    """Save and show all reports; returns the folder of each."""
    if not settings.lake_root:
        raise ValueError("lake_root must name a shared folder")
    curated = register_curated_view(read_curated(spark, settings.lake_root))
    return publish_reports(REPORTS, curated, output_dir)


def compact(spark: SparkSession, settings: Settings, before: date) -> int:
    """Rewrite days of all zones that are over; see ``compact_zone``."""
    if not settings.lake_root:
        raise ValueError("lake_root must name a shared folder")
    zones = (RAW_ZONE, CURATED_ZONE, REJECTED_ZONE, CONSUMPTION_ZONE)
    replaced = sum(compact_zone(spark, settings.lake_root, zone, before) for zone in zones)
    return replaced + compact_offsets(spark, settings.lake_root)


def refresh_summaries(spark: SparkSession, settings: Settings) -> int:
    """Bring the summaries that reports can be read from up to date; see ``summaries.refresh``."""
    if not settings.lake_root:
        raise ValueError("lake_root must name a shared folder")
    return summaries.refresh(spark, settings.lake_root)
