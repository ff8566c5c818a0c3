import glob
import tempfile
from datetime import date

import pytest
from builders import curated, messages, payload, utc
from pyspark.sql import functions as F

from gaugeline import jobs
from gaugeline.config import Settings
from gaugeline.operators.envelope import raw_envelope
from gaugeline.operators.windows import latest_revision
from gaugeline.plans import reports, serving, summaries
from gaugeline.schemas import (
    CONSUMPTION,
    CONSUMPTION_ZONE,
    CURATED_ZONE,
    OFFSETS_ZONE,
    RAW_ZONE,
    SUMMARIES_ZONE,
)
from gaugeline.sinks import compaction as C
from gaugeline.sinks.zones import (
    record_offsets,
    write_consumption,
    write_curated,
    write_offsets,
    write_raw,
    write_zone,
)
from gaugeline.sources.lake import read_consumption, read_curated, read_raw, read_zone
from gaugeline.sources.offsets import log_ranges, uncovered_directories
from gaugeline.sources.snapshots import (
    CommitConflict,
    Manifest,
    commit,
    current_manifest,
    live_directories,
)
from gaugeline.sources.tail import tail, tail_of_zone

BEFORE = date(2024, 2, 1)


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def crowded_lake(spark):
    root = folder()
    rows = [("humidity", float(n), utc(2024, 1, day, 1, n), n % 4 == 0) for day in (1, 2) for n in range(6)]
    frame = curated(spark, rows)
    for n in range(3):
        write_zone(frame.where(F.col("kafka_offset") % 3 == n), root, CURATED_ZONE, write_id=f"w{n}")
    return root, frame


def values(root, spark):
    return sorted((r.kafka_offset, r.value) for r in read_curated(spark, root).collect())


def test_readers_see_each_row_once_wherever_a_compaction_is_cut_off(spark, monkeypatch):
    root, frame = crowded_lake(spark)
    expected = values(root, spark)
    assert len(expected) == 12 and current_manifest(spark, root, CURATED_ZONE) is None

    def cut_off(*_):
        raise KeyboardInterrupt

    # After the files are written, before the commit.
    with monkeypatch.context() as patch:
        patch.setattr(C, "_commit_replacing", cut_off)
        with pytest.raises(KeyboardInterrupt):
            C.compact_zone(spark, root, CURATED_ZONE, BEFORE)
    assert len(glob.glob(f"{root}/curated/*/*/*/*/*/*compacted*")) == 2
    assert values(root, spark) == expected
    # After the commit, before old files are deleted, and in the middle of that.
    with monkeypatch.context() as patch:
        patch.setattr(C, "clean_zone", cut_off)
        with pytest.raises(KeyboardInterrupt):
            C.compact_zone(spark, root, CURATED_ZONE, BEFORE)
    assert values(root, spark) == expected
    manifest = current_manifest(spark, root, CURATED_ZONE)
    assert len(manifest.open) == len(manifest.committed) == 1
    deleted = []
    delete = C.delete_directories
    with monkeypatch.context() as patch:
        patch.setattr(C, "delete_directories", lambda s, d: (deleted.extend(d), delete(s, deleted[:2])))
        patch.setattr(C, "commit", cut_off)
        with pytest.raises(KeyboardInterrupt):
            C.clean_zone(spark, root, CURATED_ZONE)
    assert len(deleted) == 6 and values(root, spark) == expected
    # A later run finishes what is left; there is nothing to compact any more.
    assert C.compact_zone(spark, root, CURATED_ZONE, BEFORE) == 0
    assert current_manifest(spark, root, CURATED_ZONE).open == ()
    assert values(root, spark) == expected
    assert C.drop_uncommitted(spark, root, CURATED_ZONE) == 2
    assert len(glob.glob(f"{root}/curated/*/*/*/*/*/*")) == 2 and values(root, spark) == expected


def test_new_writes_and_repeated_ones_beside_open_commits(spark):
    root, frame = crowded_lake(spark)
    assert C.compact_zone(spark, root, CURATED_ZONE, date(2024, 1, 2), clean=False) == 3
    late = curated(spark, [("humidity", 99.0, utc(2024, 1, 1, 2, 2), False)]).withColumn("kafka_offset", F.lit(500).cast("bigint"))
    write_zone(late, root, CURATED_ZONE, write_id="late")
    write_zone(frame.where("day = 2 AND kafka_offset % 3 = 0"), root, CURATED_ZONE, write_id="w0")
    assert [o for o, _ in values(root, spark)] == [*range(12), 500]
    assert C.compact_zone(spark, root, CURATED_ZONE, BEFORE) == 5
    assert [o for o, _ in values(root, spark)] == [*range(12), 500]
    assert len(live_directories(spark, root, CURATED_ZONE)) == 2


def test_two_compactions_from_one_version_conflict(spark):
    root, _ = crowded_lake(spark)
    commit(spark, root, CURATED_ZONE, Manifest(0))
    commit(spark, root, CURATED_ZONE, Manifest(1, ("compacted-pending-x",)))
    with pytest.raises(CommitConflict):
        commit(spark, root, CURATED_ZONE, Manifest(1))
    # A version that is still being written has not happened yet.
    open(f"{root}/_manifests/curated/{2:012d}.json", "w").close()
    assert current_manifest(spark, root, CURATED_ZONE).version == 1
    assert len(values(root, spark)) == 12


def raw_lake(spark, root, hours, *, offsets):
    for hour in hours:
        parts = []
        for partition in (0, 1):
            if partition and hour > 2:
                continue
            texts = [payload(timestamp=hour * 10 + n) for n in range(5)]
            parts.append(messages(spark, texts, partition=partition, first_offset=hour * 5))
        rows = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
        raw = raw_envelope(rows, ingestion_time=F.lit(f"2024-01-01 0{hour % 4}:10:00").cast("timestamp"))
        write_raw(raw, root, write_id=f"w{hour}")
        if hour in offsets:
            write_offsets(raw, root, write_id=f"w{hour}")


def places(frame):
    return sorted(map(tuple, frame.select("kafka_partition", "kafka_offset").collect()))


@pytest.mark.parametrize("offsets, ends", [((), 64), ((5, 6, 7), 64), (range(8), 64), ((0, 7), 0)])
def test_tail_of_any_zone_equals_the_tail(spark, offsets, ends):
    root = folder()
    raw_lake(spark, root, range(8), offsets=offsets)
    how = {"max_literal_ends": ends, "max_broadcast_ends": ends * 10}
    for lookback in (3, 100):
        expected = places(tail(read_raw(spark, root), lookback))
        assert places(tail_of_zone(spark, root, lookback, **how)) == expected
    uncovered = 8 - len(list(offsets))
    assert len(uncovered_directories(spark, root)) == uncovered
    assert record_offsets(spark, root) == uncovered
    assert uncovered_directories(spark, root) == [] and record_offsets(spark, root) == 0
    assert places(tail_of_zone(spark, root, 7)) == places(tail(read_raw(spark, root), 7))


def test_plain_layout_and_missing_zones_have_a_tail(spark):
    root = folder()
    assert tail_of_zone(spark, root).count() == 0 and log_ranges(spark, root).count() == 0
    raw = raw_envelope(messages(spark, [payload(timestamp=n) for n in range(9)]))
    write_raw(raw, root, write_id=None)
    write_offsets(raw.limit(2), root, write_id=None)
    assert places(tail_of_zone(spark, root, 4)) == [(0, n) for n in range(5, 9)]


def test_all_zones_are_compacted(spark):
    root = folder()
    raw_lake(spark, root, range(8), offsets=range(6))
    rows = [("humidity", float(n), utc(2024, 1, day, 1, n), False) for day in (1, 2) for n in range(6)]
    for n in range(2):
        write_curated(curated(spark, rows).where(F.col("kafka_offset") % 2 == n), root, write_id=f"w{n}")
    before = places(read_raw(spark, root))
    tails = places(tail_of_zone(spark, root, 7))
    ranges = sorted((r.kafka_partition, r.first_offset, r.last_offset) for r in log_ranges(spark, root).collect())
    # Hours 0 to 3 of a day have two writes each; their ranges are recorded anew.
    replaced = jobs.compact(spark, Settings(lake_root=root), BEFORE)
    assert replaced > 8 + 4
    for zone in (RAW_ZONE, CURATED_ZONE, OFFSETS_ZONE):
        found = live_directories(spark, root, zone)
        assert len({d.values for d in found}) == len(found), zone.name
    assert len(glob.glob(f"{root}/raw/*/*/*/*/*/*/*")) == 4
    assert places(read_raw(spark, root)) == before and len(before) == 55
    assert places(tail_of_zone(spark, root, 7)) == tails
    assert uncovered_directories(spark, root) == []
    merged = log_ranges(spark, root)
    assert merged.count() < len(ranges)
    assert merged.agg(F.max("last_offset")).first()[0] == 39
    assert jobs.compact(spark, Settings(lake_root=root), BEFORE) == 0


def test_settled_revisions_replace_the_emitted_ones(spark):
    root = folder()
    row = ("2024-01-01 00:00:00", "2024-01-01 00:05:00", "humidity", 1.0, 0.0, 2.0)
    for batch, count in enumerate((1, 3, 4)):
        data = [(*row, count, 0, "sensor_averages", 2024, month) for month in (1, 2)]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONSUMPTION.fields[:-1])
        text = schema.replace("window_start timestamp, window_end timestamp", "window_start string, window_end string")
        frame = spark.createDataFrame(data, text)
        frame = frame.withColumn("window_start", F.make_timestamp(F.lit(2024), "month", F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
        frame = frame.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 5 MINUTES"))
        write_consumption(frame, root, write_id=f"w{batch}", batch_id=batch)
    settled = sorted((r.month, r.observation_count) for r in latest_revision(read_consumption(spark, root)).collect())
    # February is not over yet.
    assert C.compact_zone(spark, root, CONSUMPTION_ZONE, date(2024, 2, 29)) == 3
    stored = sorted((r.month, r.observation_count) for r in read_consumption(spark, root).collect())
    assert stored == [(1, 4), (2, 1), (2, 3), (2, 4)]
    again = latest_revision(read_consumption(spark, root)).collect()
    assert sorted((r.month, r.observation_count) for r in again) == settled == [(1, 4), (2, 4)]


# ---- summaries

def same_reports(spark, root):
    stored, rows = summaries.read_summaries(spark, root), read_curated(spark, root)
    pairs = [
        (summaries.sensor_statistics(stored), reports.sensor_statistics(rows)),
        (summaries.top_anomaly_hours(stored), reports.top_anomaly_hours(rows)),
        (summaries.daily_evolution(stored, "humidity"), reports.daily_evolution(rows, "humidity")),
        (summaries.partition_counts(stored), reports.partition_counts(rows)),
    ]
    pairs += [
        (summaries.recent_anomalies(stored, rows, limit=n), serving.recent_anomalies(rows, limit=n))
        for n in (1, 3, 500)
    ]
    for mine, full in pairs:
        assert mine.collect() == full.collect()
        assert mine.columns == full.columns
    assert summaries.recent_anomalies(stored, rows, "pressure").count() == 0


def test_only_changed_partitions_are_summarized_again(spark):
    root = folder()
    assert summaries.refresh(spark, root) == 0
    rows = [
        (sensor, 20.0 + n * 1.37, utc(2024, 1, day, n % 5, n), n % 4 == 0)
        for sensor in ("humidity", "temperature") for day in (1, 2, 3) for n in range(11)
    ]
    frame = curated(spark, rows)
    write_curated(frame.where("kafka_offset % 2 = 0"), root, write_id="a")
    assert summaries.refresh(spark, root) == 6
    same_reports(spark, root)
    assert summaries.refresh(spark, root) == 0
    # Another write into one partition, and one partition's rows replaced by others.
    write_curated(frame.where("kafka_offset % 2 = 1 AND day = 2 AND sensor_type = 'humidity'"), root, write_id="b")
    write_curated(frame.where("kafka_offset = 0"), root, write_id="a")
    assert summaries.refresh(spark, root) == 2
    same_reports(spark, root)
    # Compaction changes files, not figures; a partition that is gone takes its summary along.
    C.compact_zone(spark, root, CURATED_ZONE, BEFORE)
    assert summaries.refresh(spark, root) == 1
    same_reports(spark, root)
    for directory in live_directories(spark, root, CURATED_ZONE):
        if "sensor_type=temperature" in directory.path and "day=3" in directory.path:
            C.delete_directories(spark, [directory.path])
    assert summaries.refresh(spark, root) == 1
    same_reports(spark, root)
    assert read_zone(spark, root, SUMMARIES_ZONE).select(*summaries.PARTITION).distinct().count() == 5


def test_variances_merge_without_cancelling(spark):
    rows = [("pressure", 1e9 + n % 7 * 1e-3, utc(2024, 1, 1, n % 24, 0, n % 60), False) for n in range(500)]
    frame = curated(spark, rows)
    merged = summaries.merge(summaries.summarize(frame), "sensor_type").first()
    exact = frame.agg(F.var_pop("value"), F.avg("value")).first()
    assert merged.n == 500 and abs(merged.m2 / 500 - exact[0]) < 1e-4 * exact[0]
    alone = curated(spark, rows[:1])
    assert summaries.sensor_statistics(summaries.summarize(alone)).first().stddev_value is None


def test_recent_anomalies_open_the_newest_hours_only(spark):
    root = folder()
    rows = [("humidity", 95.0, utc(2024, 1, day, hour), True) for day in range(1, 9) for hour in (1, 2, 3)]
    write_curated(curated(spark, rows), root, write_id="a")
    summaries.refresh(spark, root)
    found = summaries.recent_anomalies(summaries.read_summaries(spark, root), read_curated(spark, root), limit=4)
    assert [(r.event_time.day, r.event_time.hour) for r in found.collect()] == [(8, 3), (8, 2), (8, 1), (7, 3)]
    files = {r[0].split("day=")[1][0] for r in read_curated(spark, root).where("day >= 7").select(F.input_file_name()).collect()}
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in scan.split("PartitionFilters: [")[1].split("]")[0] and files == {"7", "8"}
