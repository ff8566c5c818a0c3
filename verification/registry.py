"""Every query of the engine, run over the driver's ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline import jobs
from gaugeline.config import Settings
from gaugeline.functions.payloads import to_records
from gaugeline.functions.rules import RuleSet
from gaugeline.operators import decode as D
from gaugeline.operators.coverage import gaps, offset_stretches, overlaps
from gaugeline.operators.envelope import raw_envelope
from gaugeline.operators.quarantine import around, quarantined, trusted
from gaugeline.operators.reconcile import unaccounted
from gaugeline.operators.submit import accepted_events, validate_submissions
from gaugeline.operators.windows import corrected_averages, latest_revision, window_averages
from gaugeline.plans import reports, serving, summaries
from gaugeline.schemas import EVENT
from gaugeline.session import apply_runtime_settings, scratch_dir
from gaugeline.sinks.publish import to_messages
from gaugeline.sinks.compaction import compact_curated, compact_offsets, compact_zone
from gaugeline.sinks.reports import save_csv
from gaugeline.sinks.zones import (
    write_consumption,
    write_curated,
    write_offsets,
    write_raw,
    write_rejected,
    write_zone,
)
from verification.event_table import (
    as_decoded,
    as_events,
    as_faulty_messages,
    as_messages,
    as_submissions,
    read_event_table,
    stream_event_table,
)
from gaugeline.schemas import CONSUMPTION_ZONE, CURATED_ZONE, RAW_ZONE, REFUSED_ZONE, WRITE_ID
from gaugeline.sources.lake import (
    read_consumption,
    read_curated,
    read_raw,
    read_rejected,
    read_zone,
    register_curated_view,
)
from gaugeline.sources.offsets import ranges_of
from gaugeline.sources.tail import peek, tail, tail_of_zone
from gaugeline.streaming.ingest import IngestJob, drain

# Stands for the arrival of all messages, so that results can be compared.
INGESTION_SECONDS = 1_717_200_000
RECEIVED_MS = INGESTION_SECONDS * 1000
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)


def _ingestion_time() -> Column:
    return F.timestamp_seconds(F.lit(INGESTION_SECONDS))


def _table(spark: SparkSession, directory: str) -> DataFrame:
    return read_event_table(apply_runtime_settings(spark), directory)


def _raw(spark: SparkSession, directory: str) -> DataFrame:
    return raw_envelope(as_messages(_table(spark, directory)), ingestion_time=_ingestion_time())


def _faulty_raw(spark: SparkSession, directory: str) -> DataFrame:
    records = as_faulty_messages(_table(spark, directory))
    return raw_envelope(records, ingestion_time=_ingestion_time())


def _judged(spark: SparkSession, directory: str) -> DataFrame:
    arrived = f"timestamp_seconds({INGESTION_SECONDS})"
    return D.judge(as_decoded(_table(spark, directory), arrived), RuleSet())


def _curated(spark: SparkSession, directory: str) -> DataFrame:
    return D.with_curated_columns(D.accepted(_judged(spark, directory)))


def _plain_times(frame: DataFrame) -> DataFrame:
    """Timestamps without zone, as the comparison engine has them."""
    return frame.select(
        *[
            frame[field.name].cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else frame[field.name]
            for field in frame.schema.fields
        ]
    )


def _plain_averages(averages: DataFrame) -> DataFrame:
    """Window rows without the batch number, means free of summation order."""
    return _plain_times(averages.withColumn("mean_value", F.round("mean_value", 8))).drop("batch_id")


def curated_readings(spark, directory):
    return _plain_times(D.curated_readings(_raw(spark, directory)))


def envelope_roundtrip(spark, directory):
    return _plain_times(D.decode(_raw(spark, directory)))


def raw_envelope_parts(spark, directory):
    return _plain_times(_raw(spark, directory))


def reject_reasons(spark, directory):
    return _plain_times(D.rejected(_faulty_raw(spark, directory)))


def reject_counts(spark, directory):
    return D.reject_counts(D.rejected(_faulty_raw(spark, directory)))


def rejected_zone_roundtrip(spark, directory):
    """Refused messages as a backfill stores them."""
    root = scratch_dir(apply_runtime_settings(spark), "rejected-zone")
    write_rejected(D.rejected(_faulty_raw(spark, directory)), root, write_id="backfill")
    return _plain_times(read_rejected(spark, root))


def _validated(spark, directory):
    return validate_submissions(
        as_submissions(_table(spark, directory)), received_ms=f"{RECEIVED_MS}L"
    )


def submit_validation(spark, directory):
    return _validated(spark, directory).select("event_id", "event.*", "error.*")


def submit_publish(spark, directory):
    return to_messages(accepted_events(_validated(spark, directory)))


def submit_job(spark, directory):
    """What the job stores and sends: refused bodies by message, and events sent."""
    root = scratch_dir(apply_runtime_settings(spark), "submit")
    jobs.submit(
        as_submissions(_table(spark, directory)),
        Settings(lake_root=root),
        write_id="one",
        received_day=AS_OF.date(),
        received_ms=RECEIVED_MS,
        send=lambda events, settings: to_messages(events).write.parquet(f"{root}/sent"),
    )
    refused = read_zone(spark, root, REFUSED_ZONE).selectExpr("message", "status")
    sent = spark.read.parquet(f"{root}/sent").selectExpr("'' AS message", "202 AS status")
    return refused.union(sent).groupBy("message", "status").agg(F.count("*").alias("body_count"))


def top_anomaly_hours(spark, directory):
    return reports.top_anomaly_hours(_curated(spark, directory))


def sensor_statistics(spark, directory):
    return reports.sensor_statistics(_curated(spark, directory)).withColumn(
        "anomaly_rate_pct", F.col("anomaly_rate_pct").cast("double")
    )


def temperature_daily(spark, directory):
    return reports.daily_evolution(_curated(spark, directory))


def partition_counts(spark, directory):
    return reports.partition_counts(_curated(spark, directory))


def partition_keys(spark, directory):
    return _curated(spark, directory).select(*reports.PARTITION_KEYS).distinct()


def daily_stats(spark, directory):
    return serving.daily_stats(_curated(spark, directory), "Humidity", 7, as_of=AS_OF)


def daily_stats_records(spark, directory):
    return to_records(serving.daily_stats(_curated(spark, directory), "pressure", 90, as_of=AS_OF))


def recent_anomalies(spark, directory):
    return _plain_times(serving.recent_anomalies(_curated(spark, directory)))


def recent_anomalies_of_sensor(spark, directory):
    return _plain_times(serving.recent_anomalies(_curated(spark, directory), "temperature", 500))


def latest_reading(spark, directory):
    found = serving.latest_reading(_raw(spark, directory), "humidity")
    return found.select(*EVENT.fieldNames(), "_kafka.partition", "_kafka.offset")


def tail_messages(spark, directory):
    return tail(_raw(spark, directory)).select("kafka_partition", "kafka_offset", "json_payload")


def peek_messages(spark, directory):
    return peek(_raw(spark, directory), ordered=True)


def recent_anomaly_records(spark, directory):
    """Records with timestamps, and NULL for a flag that tells nothing."""
    recent = serving.recent_anomalies(_curated(spark, directory), limit=50)
    flag = F.when(F.col("sensor_type") != "humidity", F.col("producer_anomaly"))
    return to_records(recent.withColumn("producer_anomaly", flag))


def sensor_units(spark, directory):
    """The list itself, for the sensors that the table has."""
    met = _curated(spark, directory).select("sensor_type").distinct()
    units = serving.sensor_units(spark)
    return units.join(met, units["sensor"] == met["sensor_type"], "left_semi")


def reading_counts(spark, directory):
    return serving.reading_counts(_curated(spark, directory))


def anomaly_ratio(spark, directory):
    return serving.run_summary(as_events(_table(spark, directory)))


def publish_messages(spark, directory):
    return to_messages(as_events(_table(spark, directory)))


def replays_dropped(spark, directory):
    """Every message stored twice, in two topics that share all places in the log."""
    once = _curated(spark, directory)
    other = once.withColumn("topic", F.lit("other"))
    both = once.union(other)
    return _plain_times(D.drop_replayed(both.union(both)))


def window_averages_batch(spark, directory):
    return _plain_averages(window_averages(_curated(spark, directory)))


def _job(spark: SparkSession, label: str, **options) -> IngestJob:
    scratch = scratch_dir(spark, label)
    return IngestJob(
        f"{scratch}/lake",
        f"{scratch}/checkpoints",
        trigger_interval=None,
        label=f"{label}-",
        **options,
    )


def window_averages_stream_update(spark, directory):
    job = _job(apply_runtime_settings(spark), "stream-update")
    drain([job.start_windows(as_messages(stream_event_table(spark, directory)))])
    return _plain_averages(latest_revision(read_consumption(spark, job.lake)))


def window_averages_stream_append(spark, directory):
    job = _job(apply_runtime_settings(spark), "stream-append")
    messages = as_messages(stream_event_table(spark, directory))
    drain([job.start_windows(messages, output_mode="append")])
    return _plain_averages(read_consumption(spark, job.lake))


def window_averages_stream_repeats(spark, directory):
    """Windows of a stream in which every message comes twice."""
    spark = apply_runtime_settings(spark)
    log = scratch_dir(spark, "repeats")
    messages = as_messages(_table(spark, directory))
    for copy in range(2):
        messages.write.parquet(f"{log}/copy={copy}")
    job = _job(spark, "stream-repeats", windows_without_repeats=True)
    stream = spark.readStream.schema(messages.schema).parquet(f"{log}/copy=*")
    drain([job.start_windows(stream)])
    return _plain_averages(latest_revision(read_consumption(spark, job.lake)))


def window_averages_stream_revisions(spark, directory):
    """Day windows over the table in five slices of time that cut through days,
    so windows are emitted again and the reader has to settle the revisions."""
    table = _table(spark, directory)
    slices = scratch_dir(spark, "slices")
    first, last = table.agg(F.min("ts"), F.max("ts")).first()
    seconds = (last - first).total_seconds()
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    since = micros - F.unix_micros(F.lit(first).cast("timestamp"))
    slice_of = F.least(F.floor(since * 5 / max(1, int(seconds * 1e6))), F.lit(4)).alias("slice")
    table.select("*", slice_of).repartition("slice").write.partitionBy("slice").parquet(slices)
    stream = (
        spark.readStream.schema(table.schema)
        .option("maxFilesPerTrigger", 2)
        .parquet(f"{slices}/slice=*")
    )
    # Slices come in any order, so the watermark covers the whole span of the table.
    span = f"{int(seconds) + 1} seconds"
    job = _job(spark, "stream-revisions", window="1 day", watermark=span)
    drain([job.start_windows(as_messages(stream))])
    return _plain_averages(latest_revision(read_consumption(spark, job.lake)))


def window_averages_stream_late(spark, directory):
    """Windows of a stream whose last batch comes far too late and is left out.

    Every 17th event before the middle of the table arrives after all the others."""
    table = _table(spark, directory)
    log = scratch_dir(spark, "late")
    first, last = table.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(first + (last - first) / 2).cast("timestamp_ntz")
    early, late = F.col("ts") < middle, F.col("event_id") % 17 == 0
    parts = [early & ~late, ~early, early & late]
    job = _job(spark, "stream-late", watermark="2 minutes")
    for number, part in enumerate(parts):
        # A query over what has arrived so far, continued from the same checkpoint.
        table.where(part).write.parquet(f"{log}/part={number}")
        stream = spark.readStream.schema(table.schema).parquet(f"{log}/part=*")
        drain([job.start_windows(as_messages(stream))])
    return _plain_averages(latest_revision(read_consumption(spark, job.lake)))


def stream_ingest_zones(spark, directory):
    """The three streaming writers together; rows per zone and sensor."""
    job = _job(apply_runtime_settings(spark), "ingest")
    drain(job.start(as_messages(stream_event_table(spark, directory))))
    zones = {
        "raw": read_raw(spark, job.lake).withColumnRenamed("message_key", "sensor_type"),
        "curated": read_curated(spark, job.lake),
        "consumption": latest_revision(read_consumption(spark, job.lake)),
        "rejected": read_rejected(spark, job.lake),
    }
    return _zone_counts(zones)


def stream_ingest_shared(spark, directory):
    """As above with raw and curated written from shared batches."""
    job = _job(apply_runtime_settings(spark), "ingest-shared")
    drain(job.start(as_messages(stream_event_table(spark, directory)), shared_batches=True))
    zones = {
        "raw": read_raw(spark, job.lake).withColumnRenamed("message_key", "sensor_type"),
        "curated": read_curated(spark, job.lake),
        "consumption": latest_revision(read_consumption(spark, job.lake)),
        "rejected": read_rejected(spark, job.lake),
    }
    return _zone_counts(zones)


def _zone_counts(zones: dict[str, DataFrame]) -> DataFrame:
    counts = None
    for name, rows in zones.items():
        count = rows.groupBy("sensor_type").agg(F.count("*").alias("row_count"))
        count = count.select(F.lit(name).alias("zone"), "sensor_type", "row_count")
        counts = count if counts is None else counts.union(count)
    return counts


def _curated_lake(spark: SparkSession, directory: str, label: str) -> str:
    root = scratch_dir(apply_runtime_settings(spark), label)
    write_curated(_curated(spark, directory), root, write_id="backfill")
    return root


def raw_zone_roundtrip(spark, directory):
    root = scratch_dir(apply_runtime_settings(spark), "raw-zone")
    write_raw(_raw(spark, directory), root, write_id="backfill")
    return _plain_times(read_raw(spark, root))


def zone_roundtrip(spark, directory):
    return _plain_times(read_curated(spark, _curated_lake(spark, directory, "curated-zone")))


def consumption_zone_roundtrip(spark, directory):
    root = scratch_dir(apply_runtime_settings(spark), "consumption-zone")
    averages = window_averages(_curated(spark, directory))
    write_consumption(averages, root, write_id="backfill", batch_id=0)
    return _plain_averages(read_consumption(spark, root))


def rerun_zone(spark, directory):
    """All zones after a backfill of everything was run again for half of it."""
    job = _job(apply_runtime_settings(spark), "rerun")
    table = _table(spark, directory)
    middle = table.agg(F.expr("timestamp_micros(bigint(avg(unix_micros(timestamp(ts)))))")).first()[0]
    half = table.where(F.col("ts").cast("timestamp") < F.lit(middle))
    for rows in (table, half):
        job.run_batch(as_messages(rows), write_id="one", ingestion_time=_ingestion_time())
    return _zone_counts(
        {
            "raw": read_raw(spark, job.lake).withColumnRenamed("message_key", "sensor_type"),
            "curated": read_curated(spark, job.lake),
            "consumption": read_consumption(spark, job.lake),
            "rejected": read_rejected(spark, job.lake),
        }
    )


def compacted_zone(spark, directory):
    """Three writes a day and a repeated one, then all closed days in one write each."""
    root = scratch_dir(apply_runtime_settings(spark), "compacted")
    curated = _curated(spark, directory)
    third = F.col("kafka_offset") % 3
    for number in range(3):
        write_zone(curated.where(third == number), root, CURATED_ZONE, write_id=f"w{number}")
    write_zone(curated.where(third == 0), root, CURATED_ZONE, write_id="again")
    compact_curated(spark, root, AS_OF.date())
    stored = spark.read.schema(CURATED_ZONE.stored_schema).parquet(f"{root}/curated")
    return stored.groupBy("sensor_type").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("year", "month", "day", WRITE_ID).alias("directories"),
        F.round(F.sum("value"), 2).alias("total"),
    )


def partition_counts_from_zone(spark, directory):
    """Of the stored zone; the second number from a scan of that partition alone."""
    stored = read_curated(spark, _curated_lake(spark, directory, "partition-counts"))
    keys = reports.first_partition(stored)
    counts = reports.partition_counts(stored)
    if keys is None:
        return counts
    pruned = reports.in_partition(stored, *keys).agg(F.count("*").cast("string")).select(
        F.lit("partition_pruned"), "*", *(F.lit(str(key)) for key in keys)
    )
    return counts.where("query_type = 'full_scan'").union(pruned)


def daily_stats_from_zone(spark, directory):
    stored = read_curated(spark, _curated_lake(spark, directory, "daily-stats"))
    return serving.daily_stats(stored, "humidity", 7, as_of=AS_OF)


def recent_anomalies_from_zone(spark, directory):
    stored = read_curated(spark, _curated_lake(spark, directory, "recent"))
    return _plain_times(serving.recent_anomalies(stored, limit=500))


def _hourly_lake(spark: SparkSession, directory: str) -> str:
    """The raw zone as messages arrived hour by hour, with its offsets."""
    root = scratch_dir(apply_runtime_settings(spark), "hourly")
    arrived = F.date_trunc("hour", "timestamp")
    raw = raw_envelope(as_messages(_table(spark, directory)), ingestion_time=arrived)
    write_raw(raw, root, write_id="backfill", hours=True)
    write_offsets(raw, root, write_id="backfill")
    return root


def tail_from_zone(spark, directory):
    found = tail_of_zone(spark, _hourly_lake(spark, directory))
    return found.select("kafka_partition", "kafka_offset", "json_payload")


def latest_reading_from_zone(spark, directory):
    found = serving.newest_of(tail_of_zone(spark, _hourly_lake(spark, directory)), "humidity")
    return found.select(*EVENT.fieldNames(), "_kafka.partition", "_kafka.offset")


def tail_from_mixed_zone(spark, directory):
    """A zone whose older writes, and all of one log partition, have no recorded offsets."""
    root = scratch_dir(apply_runtime_settings(spark), "mixed")
    arrived = F.date_trunc("hour", "timestamp")
    raw = raw_envelope(as_messages(_table(spark, directory)), ingestion_time=arrived)
    middle = raw.agg(F.expr("timestamp_micros(bigint(avg(unix_micros(kafka_timestamp))))")).first()[0]
    older = (F.col("kafka_timestamp") < F.lit(middle)) | (F.col("kafka_partition") == 2)
    write_raw(raw.where(older), root, write_id="before", hours=True)
    write_raw(raw.where(~older), root, write_id="after", hours=True)
    write_offsets(raw.where(~older), root, write_id="after")
    return tail_of_zone(spark, root).select("kafka_partition", "kafka_offset", "json_payload")


def tail_from_compacted_zone(spark, directory):
    """The raw zone and its offset index after both were written to by hours and compacted."""
    root = scratch_dir(apply_runtime_settings(spark), "compacted-raw")
    arrived = F.date_trunc("day", "timestamp")
    raw = raw_envelope(as_messages(_table(spark, directory)), ingestion_time=arrived)
    for number in range(3):
        part = raw.where(F.col("kafka_offset") % 3 == number)
        write_raw(part, root, write_id=f"w{number}", hours=True)
        write_offsets(part, root, write_id=f"w{number}")
    compact_zone(spark, root, RAW_ZONE, AS_OF.date())
    compact_offsets(spark, root)
    return tail_of_zone(spark, root).select("kafka_partition", "kafka_offset", "json_payload")


def log_gaps(spark, directory):
    """What is missing of a log that lost a stretch of every thousand events."""
    places = _judged(spark, directory).select("topic", "kafka_partition", "kafka_offset")
    event = F.col("kafka_offset") * 3 + F.col("kafka_partition")
    return gaps(offset_stretches(places.where(~(event % 1000).between(100, 120)), block=1000))


def log_overlaps(spark, directory):
    """Offsets that several recorded ranges cover: every hour's, and some days read again."""
    messages = as_messages(_table(spark, directory))
    by_hour, by_day = (
        ranges_of(raw_envelope(messages, ingestion_time=F.date_trunc(unit, "timestamp")), F.lit(unit))
        for unit in ("hour", "day")
    )
    return overlaps(by_hour.union(by_day.where("day % 3 = 1")), block=1000)


def unaccounted_messages(spark, directory):
    """Messages that a curated zone lost, or holds twice, against the raw zone."""
    judged = _judged(spark, directory)
    curated = D.with_curated_columns(D.accepted(judged))
    refused = D.rejected(_raw(spark, directory))
    lost, twice = F.col("kafka_offset") % 997 == 5, F.col("kafka_offset") % 1013 == 7
    stored = curated.where(~lost).union(curated.where(twice & ~lost))
    return unaccounted(judged, stored, refused, steps=(10_000, 100, 1))


def _summarized_lake(spark: SparkSession, directory: str, label: str) -> str:
    """Summaries brought up to date after each of two writes, the second into old and new days."""
    root = scratch_dir(apply_runtime_settings(spark), label)
    curated = _curated(spark, directory)
    first = (F.col("day") < 11) & (F.col("kafka_offset") % 4 > 0)
    write_curated(curated.where(first), root, write_id="one")
    summaries.refresh(spark, root)
    write_curated(curated.where(~first), root, write_id="two")
    summaries.refresh(spark, root)
    return root


def sensor_statistics_from_summaries(spark, directory):
    root = _summarized_lake(spark, directory, "summary-statistics")
    found = summaries.sensor_statistics(summaries.read_summaries(spark, root))
    return found.withColumn("anomaly_rate_pct", F.col("anomaly_rate_pct").cast("double"))


def top_anomaly_hours_from_summaries(spark, directory):
    root = _summarized_lake(spark, directory, "summary-hours")
    return summaries.top_anomaly_hours(summaries.read_summaries(spark, root))


def temperature_daily_from_summaries(spark, directory):
    root = _summarized_lake(spark, directory, "summary-days")
    return summaries.daily_evolution(summaries.read_summaries(spark, root))


def partition_counts_from_summaries(spark, directory):
    root = _summarized_lake(spark, directory, "summary-counts")
    return summaries.partition_counts(summaries.read_summaries(spark, root))


def recent_anomalies_from_summaries(spark, directory):
    root = _summarized_lake(spark, directory, "summary-recent")
    stored = summaries.read_summaries(spark, root), read_curated(spark, root)
    return _plain_times(summaries.recent_anomalies(*stored, limit=500))


def zone_while_compacting(spark, directory):
    """A zone with replays after the commit of a compaction whose old files are still there."""
    root = scratch_dir(apply_runtime_settings(spark), "compacting")
    curated = _curated(spark, directory)
    third = F.col("kafka_offset") % 3
    for number, write_id in ((0, "w0"), (1, "w1"), (2, "w2"), (0, "again")):
        write_zone(curated.where(third == number), root, CURATED_ZONE, write_id=write_id)
    compact_zone(spark, root, CURATED_ZONE, AS_OF.date() + timedelta(days=1), clean=False)
    return _plain_times(read_curated(spark, root))


def settled_consumption(spark, directory):
    """Revisions of day windows settled on disk, read without settling them again."""
    averages = window_averages(_curated(spark, directory), window="1 day")
    root = scratch_dir(apply_runtime_settings(spark), "settled")
    for batch in range(3):
        # Each batch emits the windows grown so far.
        grown = averages if batch == 2 else averages.withColumn(
            "observation_count", F.col("observation_count") - (2 - batch)
        ).withColumn("mean_value", F.col("mean_value") - 1)
        write_consumption(grown, root, write_id=f"w{batch}", batch_id=batch)
    compact_zone(spark, root, CONSUMPTION_ZONE, AS_OF.date() + timedelta(days=1))
    return _plain_averages(read_consumption(spark, root))


def guarded_scans(spark, directory):
    """Rows of a zone that is there and of one that is not."""
    root = _curated_lake(spark, directory, "guarded")
    scans = {"there": read_curated(spark, root), "missing": read_curated(spark, f"{root}/nowhere")}
    counted = [
        rows.agg(F.lit(name).alias("zone"), F.count("*").alias("row_count")) for name, rows in scans.items()
    ]
    return counted[0].union(counted[1])


def curated_view_sql(spark, directory):
    """The registered view, asked in SQL."""
    register_curated_view(read_curated(spark, _curated_lake(spark, directory, "view")))
    return spark.sql(
        """SELECT sensor_type, count(*) AS row_count, count_if(is_anomaly) AS anomaly_count
           FROM curated_readings GROUP BY sensor_type"""
    )


def daily_stats_of_text_times(spark, directory):
    """Times that came as text, some of them unreadable."""
    curated = _curated(spark, directory)
    text = F.when(F.col("kafka_offset") % 10 == 3, F.lit("soon")).otherwise(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")
    )
    return serving.daily_stats(curated.withColumn("event_time", text), "humidity", 7, as_of=AS_OF)


def quarantined_readings(spark, directory):
    """Readings within ten minutes of an implausible one of their sensor."""
    judged = _judged(spark, directory)
    implausible = judged.where("known AND time_ok AND NOT plausible")
    bad = around(implausible, "10 MINUTES", "10 MINUTES")
    return _plain_times(quarantined(_curated(spark, directory), bad, bin_seconds=3600))


def trusted_counts(spark, directory):
    """All other readings, by sensor."""
    judged = _judged(spark, directory)
    implausible = judged.where("known AND time_ok AND NOT plausible")
    bad = around(implausible, "10 MINUTES", "10 MINUTES")
    left = trusted(_curated(spark, directory), bad)
    return left.groupBy("sensor_type").agg(F.count("*").alias("row_count"))


def late_windows_corrected(spark, directory):
    """Window rows of a stream that left out late rows, after those windows were made anew."""
    root = scratch_dir(apply_runtime_settings(spark), "corrected")
    curated = _curated(spark, directory)
    late = F.col("kafka_offset") % 17 == 0
    write_curated(curated, root, write_id="all")
    stored = read_curated(spark, root)
    write_consumption(window_averages(stored.where(~late)), root, write_id="stream", batch_id=0)
    corrected = corrected_averages(stored, stored.where(late))
    write_consumption(corrected, root, write_id="correction", batch_id=1)
    return _plain_averages(latest_revision(read_consumption(spark, root)))


def report_csv(spark, directory):
    report = top_anomaly_hours(spark, directory)
    target = save_csv(report, scratch_dir(spark, "reports"))
    return spark.read.schema(report.schema).option("header", True).csv(target)


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "curated_readings": curated_readings,
    "envelope_roundtrip": envelope_roundtrip,
    "raw_envelope_parts": raw_envelope_parts,
    "reject_reasons": reject_reasons,
    "reject_counts": reject_counts,
    "rejected_zone_roundtrip": rejected_zone_roundtrip,
    "submit_validation": submit_validation,
    "submit_publish": submit_publish,
    "submit_job": submit_job,
    "top_anomaly_hours": top_anomaly_hours,
    "sensor_statistics": sensor_statistics,
    "temperature_daily": temperature_daily,
    "partition_counts": partition_counts,
    "partition_keys": partition_keys,
    "daily_stats": daily_stats,
    "daily_stats_records": daily_stats_records,
    "recent_anomalies": recent_anomalies,
    "recent_anomalies_of_sensor": recent_anomalies_of_sensor,
    "recent_anomaly_records": recent_anomaly_records,
    "latest_reading": latest_reading,
    "tail_messages": tail_messages,
    "peek_messages": peek_messages,
    "sensor_units": sensor_units,
    "reading_counts": reading_counts,
    "anomaly_ratio": anomaly_ratio,
    "publish_messages": publish_messages,
    "replays_dropped": replays_dropped,
    "window_averages": window_averages_batch,
    "window_averages_stream_update": window_averages_stream_update,
    "window_averages_stream_append": window_averages_stream_append,
    "window_averages_stream_repeats": window_averages_stream_repeats,
    "window_averages_stream_revisions": window_averages_stream_revisions,
    "window_averages_stream_late": window_averages_stream_late,
    "stream_ingest_zones": stream_ingest_zones,
    "stream_ingest_shared": stream_ingest_shared,
    "raw_zone_roundtrip": raw_zone_roundtrip,
    "zone_roundtrip": zone_roundtrip,
    "consumption_zone_roundtrip": consumption_zone_roundtrip,
    "rerun_zone": rerun_zone,
    "compacted_zone": compacted_zone,
    "partition_counts_from_zone": partition_counts_from_zone,
    "daily_stats_from_zone": daily_stats_from_zone,
    "recent_anomalies_from_zone": recent_anomalies_from_zone,
    "tail_from_zone": tail_from_zone,
    "latest_reading_from_zone": latest_reading_from_zone,
    "report_csv": report_csv,
    "tail_from_mixed_zone": tail_from_mixed_zone,
    "tail_from_compacted_zone": tail_from_compacted_zone,
    "log_gaps": log_gaps,
    "log_overlaps": log_overlaps,
    "unaccounted_messages": unaccounted_messages,
    "sensor_statistics_from_summaries": sensor_statistics_from_summaries,
    "top_anomaly_hours_from_summaries": top_anomaly_hours_from_summaries,
    "temperature_daily_from_summaries": temperature_daily_from_summaries,
    "partition_counts_from_summaries": partition_counts_from_summaries,
    "recent_anomalies_from_summaries": recent_anomalies_from_summaries,
    "zone_while_compacting": zone_while_compacting,
    "settled_consumption": settled_consumption,
    "guarded_scans": guarded_scans,
    "curated_view_sql": curated_view_sql,
    "daily_stats_of_text_times": daily_stats_of_text_times,
    "quarantined_readings": quarantined_readings,
    "trusted_counts": trusted_counts,
    "late_windows_corrected": late_windows_corrected,
}
