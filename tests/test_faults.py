"""Rows must neither get lost nor be met twice: reruns, replays, folders, damage."""

import glob
import tempfile
import time
from datetime import date

import pytest
from builders import curated, messages, millis, payload, utc
from pyspark.sql import functions as F

from gaugeline import jobs
from gaugeline.config import Settings
from gaugeline.functions.rules import DEFAULT_RULES, RuleSet, SensorRule
from gaugeline.operators.decode import curated_readings, drop_replayed, near_arrival
from gaugeline.operators.envelope import raw_envelope
from gaugeline.operators.submit import validate_submissions
from gaugeline.schemas import CURATED_ZONE, RAW_ZONE, REFUSED_ZONE
from gaugeline.sinks.compaction import compact_curated
from gaugeline.sinks.zones import write_offsets, write_raw, write_zone
from gaugeline.sources.lake import read_consumption, read_curated, read_raw, read_rejected, read_zone
from gaugeline.sources.tail import tail, tail_of_zone
from gaugeline.streaming.ingest import IngestJob, drain
from verification.event_table import as_messages, read_event_table, stream_event_table

SMALL = "/root/testdata/sf0.001"


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def job(**options):
    root = folder()
    return IngestJob(f"{root}/lake", f"{root}/checkpoints", trigger_interval=None, **options)


@pytest.mark.parametrize("files", [1, 3])
def test_stream_of_a_table_in_a_folder(spark, files):
    root = folder()
    table = read_event_table(spark, SMALL)
    table.repartition(files).write.parquet(f"{root}/events.parquet")
    ingest = job()
    drain([ingest.start_windows(as_messages(stream_event_table(spark, root)))])
    got = read_consumption(spark, ingest.lake).agg(F.sum("observation_count")).first()[0]
    assert got == curated_readings(raw_envelope(as_messages(table))).count() > 0


def test_replays_are_told_from_other_topics_and_from_a_topic_made_anew(spark):
    first = messages(spark, [payload(value=1.0)] * 3)
    other = first.withColumn("topic", F.lit("other"))
    anew = messages(spark, [payload(value=2.0)] * 3, arrived=utc(2025, 1, 1))
    rows = curated_readings(raw_envelope(first.union(other).union(anew)))
    assert drop_replayed(rows.union(rows)).count() == 9


@pytest.mark.parametrize("hour", [3, 4])
def test_rerun_with_other_rows_leaves_nothing_of_the_first_try(spark, hour):
    ingest = job()
    times = [millis(utc(2024, 1, day, 1)) for day in (1, 2, 3)]
    rows = messages(spark, [payload(timestamp=t) for t in times] + ["broken"], arrived=utc(2024, 1, 5))
    arrived = F.lit("2024-02-01 03:30:00").cast("timestamp")
    ingest.run_batch(rows, write_id="w", ingestion_time=arrived)
    third = messages(spark, [payload(timestamp=times[2])], arrived=utc(2024, 1, 5))
    ingest.run_batch(third, write_id="other", ingestion_time=arrived)
    fewer = messages(spark, [payload(timestamp=times[0])])
    later = F.lit(f"2024-02-01 0{hour}:30:00").cast("timestamp")
    ingest.run_batch(fewer, write_id="w", ingestion_time=later)
    assert read_raw(spark, ingest.lake).count() == 2
    assert sorted(r["day"] for r in read_curated(spark, ingest.lake).collect()) == [1, 3]
    assert read_consumption(spark, ingest.lake).count() == 2
    assert read_rejected(spark, ingest.lake).count() == 0


def test_no_rows_for_a_rerun_empties_the_write(spark):
    root = folder()
    rows = curated(spark, [("humidity", 50.0, utc(2024, 1, 1), False)])
    write_zone(rows, root, CURATED_ZONE, write_id="w", rerun=True)
    write_zone(rows.where("false"), root, CURATED_ZONE, write_id="w", rerun=True)
    assert read_curated(spark, root).count() == 0


def test_a_growing_log_gives_no_more_than_the_tail(spark):
    """The second pass of the tail sees rows that the first one did not."""
    root = folder()
    records = lambda n, first: raw_envelope(messages(spark, [payload()] * n, first_offset=first))
    records(10, 0).write.parquet(f"{root}/log")
    raw = spark.read.schema(records(1, 0).schema).parquet(f"{root}/log")
    for way in ({}, {"max_literal_ends": 0}):
        found = tail(raw, 4, **way)
        assert sorted(r["kafka_offset"] for r in found.collect()) == [6, 7, 8, 9]
    plan = tail(raw, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "kafka_offset" in plan and "<= 9" in plan


def test_a_damaged_raw_line_is_an_error(spark):
    root = folder()
    write_zone(raw_envelope(messages(spark, [payload()])), root, RAW_ZONE, write_id=None)
    with open(glob.glob(f"{root}/raw/*/*/*/*/*/*")[0] + "/damaged.json", "w") as stored:
        stored.write('{"message_key":"a","json_pay\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw(spark, root).collect()


def test_raw_and_curated_have_the_same_ingestion_time(spark):
    ingest = job()
    arrived = F.lit("2024-02-01 03:30:00.123456").cast("timestamp")
    ingest.run_batch(messages(spark, [payload()]), write_id="w", ingestion_time=arrived)
    times = {
        rows.first()["ingestion_time"]
        for rows in (read_raw(spark, ingest.lake), read_curated(spark, ingest.lake))
    }
    assert len(times) == 1 and times.pop().microsecond == 123456


def test_an_event_of_the_far_future_is_kept_out_of_windows(spark):
    rows = messages(
        spark, [payload(timestamp=millis(utc(y, 1, 1))) for y in (2024, 9999, 2023)]
    )
    ingest = job()
    ingest.run_batch(rows, write_id="w")
    assert read_curated(spark, ingest.lake).count() == 3
    assert read_consumption(spark, ingest.lake).count() == 2
    refusing = job(max_future_skew="1 hour")
    refusing.run_batch(rows, write_id="w")
    assert read_curated(spark, refusing.lake).count() == 2
    assert [r["reject_reason"] for r in read_rejected(spark, refusing.lake).collect()] == [
        "timestamp_out_of_range"
    ]
    nulls = curated_readings(raw_envelope(rows)).withColumn("kafka_timestamp", F.lit(None).cast("timestamp"))
    assert near_arrival(nulls, "1 day").count() == 3


def test_tail_of_a_zone_opens_only_its_hours(spark):
    root = folder()
    for hour in range(8):
        # Partition 1 gets nothing after the first hours.
        texts = [payload(timestamp=hour * 10 + n) for n in range(5)]
        parts = [messages(spark, texts, partition=p, first_offset=hour * 5) for p in (0, 1) if not p or hour < 3]
        rows = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
        arrived = F.lit(f"2024-01-01 0{hour}:10:00").cast("timestamp")
        raw = raw_envelope(rows, ingestion_time=arrived)
        write_raw(raw, root, write_id=f"w{hour}")
        write_offsets(raw, root, write_id=f"w{hour}")
    found = tail_of_zone(spark, root, 7)
    expected = tail(read_raw(spark, root), 7)
    columns = ["kafka_partition", "kafka_offset"]
    assert sorted(found.select(columns).collect()) == sorted(expected.select(columns).collect())
    assert found.count() == 14
    scan = found._jdf.queryExecution().executedPlan().toString().split("FileScan")[1]
    assert "hour" in scan.split("PartitionFilters: [")[1].split("]")[0]
    hours = {name.split("hour=")[1][0] for (name,) in found.select(F.input_file_name()).distinct().collect()}
    assert hours == {"1", "2", "6", "7"}


def test_compaction_keeps_rows_and_leaves_open_days_alone(spark):
    root = folder()
    rows = [("humidity", float(n), utc(2024, 1, day, 1, n), False) for day in (1, 2) for n in range(6)]
    frame = curated(spark, rows)
    for n in range(3):
        write_zone(frame.where(F.col("kafka_offset") % 3 == n), root, CURATED_ZONE, write_id=f"w{n}")
    write_zone(frame.where("kafka_offset % 3 = 0"), root, CURATED_ZONE, write_id="again")
    assert read_curated(spark, root).count() == 16
    assert compact_curated(spark, root, date(2024, 1, 2)) == 4
    leaves = glob.glob(f"{root}/curated/*/*/*/*/day=1/*")
    assert len(leaves) == 1 and "compacted-" in leaves[0]
    assert len(glob.glob(f"{root}/curated/*/*/*/*/day=2/*")) == 4
    assert read_curated(spark, root).where("day = 1").count() == 6
    assert jobs.compact(spark, Settings(lake_root=root), date(2024, 1, 2)) == 0
    with pytest.raises(ValueError):
        jobs.compact(spark, Settings(), date(2024, 1, 2))


def test_submit_job(spark):
    root = folder()
    bodies = [
        payload(sensor="temperature", value=20.0, unit="C", timestamp=5),
        "not json",
        payload(sensor="temperature", value=500.0, unit="C"),
    ]
    frame = spark.createDataFrame([(b,) for b in bodies], "body string")
    sent = []
    for _ in range(2):
        jobs.submit(
            frame,
            Settings(lake_root=root),
            write_id="w",
            received_day=date(2024, 1, 1),
            received_ms=7,
            send=lambda events, _: sent.append([r["value"] for r in events.collect()]),
        )
    assert sent == [[20.0], [20.0]]
    refused = read_zone(spark, root, REFUSED_ZONE)
    assert sorted((r["status"], r["message"]) for r in refused.collect()) == [
        (400, "Malformed JSON request body"),
        (422, "Value for temperature must be between -50.0 and 80.0"),
    ]


def test_many_rules_cost_no_more_than_a_join(spark):
    bodies = spark.range(1000).selectExpr(
        """concat('{"sensor":"s', id, '","value":0.5,"unit":"u","source":"x"}') AS body"""
    )

    def seconds(count):
        rules = RuleSet([*DEFAULT_RULES, *(SensorRule(f"s{n}", "u", 0.0, 1.0) for n in range(count))])
        answered = validate_submissions(bodies, rules, received_ms="0L")
        best = 1e9
        for _ in range(2):
            start = time.perf_counter()
            accepted = answered.where("error IS NULL").count()
            best = min(best, time.perf_counter() - start)
        assert accepted == min(count, 1000)
        return best

    assert seconds(5000) < 3 * seconds(100) + 3
