"""Layout of the zones, pruning, reports and serving over a stored lake."""

import glob
import os
import tempfile
from datetime import datetime

import pytest
from builders import curated, messages, millis, payload, tuples, utc
from pyspark.sql import functions as F

from gaugeline import jobs
from gaugeline.config import Settings
from gaugeline.functions.payloads import to_records
from gaugeline.functions.times import partition_day
from gaugeline.operators.decode import curated_readings
from gaugeline.operators.envelope import raw_envelope
from gaugeline.plans import reports, serving
from gaugeline.schemas import CURATED, CURATED_ZONE, KAFKA_RECORD, RAW, RAW_ZONE
from gaugeline.sinks.reports import save_csv
from gaugeline.sinks.zones import write_curated, write_zone
from gaugeline.sources.lake import (
    read_consumption,
    read_curated,
    read_raw,
    register_curated_view,
    zone_path,
)
from gaugeline.sources.messages import ReplaySource

DAYS = range(1, 11)


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="module")
def lake(spark):
    """Ten days, three sensors, two readings each per day; the later is anomalous."""
    level = {"temperature": (20.0, 40.0), "humidity": (50.0, 95.0), "pressure": (1000.0, 950.0)}
    rows = [
        (sensor, value + day / 10, utc(2024, 3, day, hour), hour == 18)
        for day in DAYS
        for sensor, values in level.items()
        for hour, value in zip((6, 18), values)
    ]
    root = folder()
    write_curated(curated(spark, rows), root, write_id="w1")
    return root


def scan_of(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("FileScan") :]


def files_of(frame):
    return len(frame.select(F.input_file_name()).distinct().collect())


def test_curated_layout(spark, lake):
    parts = glob.glob(f"{lake}/curated/*/*/*/*/*/*")
    assert len(parts) == 30
    assert (
        f"{lake}/curated/domain=iot/sensor_type=humidity/year=2024/month=3/day=7/write_id=w1"
        in parts
    )
    stored = read_curated(spark, lake)
    assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in CURATED]
    assert all(path.endswith(".snappy.parquet") for path in glob.glob(f"{parts[0]}/*"))


def test_partition_filter_prunes(spark, lake):
    stored = read_curated(spark, lake)
    pruned = reports.in_partition(stored, "humidity", 2024, 3, 7)
    partition_filters = scan_of(pruned).split("PartitionFilters: [")[1].split("]")[0]
    for column in ("sensor_type", "year", "month", "day"):
        assert f"({column}#" in partition_filters
    assert (files_of(stored), files_of(pruned), pruned.count()) == (30, 1, 2)
    assert reports.first_partition(stored) == ("humidity", 2024, 3, 1)
    assert tuples(reports.partition_counts(stored)) == [
        ("full_scan", "60", "", "", "", ""),
        ("partition_pruned", "2", "humidity", "2024", "3", "1"),
    ]
    # Counting by partition reads no column of the files.
    assert "ReadSchema: struct<>" in scan_of(reports.partition_counts(stored))


def test_partition_counts_without_data(spark):
    empty = read_curated(spark, folder())
    assert reports.first_partition(empty) is None
    assert reports.partition_counts(empty).count() == 0


def test_reports_read_only_their_columns(spark, lake):
    stored = read_curated(spark, lake)
    scan = scan_of(reports.sensor_statistics(stored))
    assert "ReadSchema: struct<value:double,is_anomaly:boolean>" in scan
    scan = scan_of(reports.top_anomaly_hours(stored))
    assert "ReadSchema: struct<event_time:timestamp,is_anomaly:boolean>" in scan
    assert "PushedFilters: [IsNotNull(is_anomaly), EqualTo(is_anomaly,true)]" in scan
    assert "sensor_type" in scan_of(reports.daily_evolution(stored)).split("PartitionFilters")[1]


def test_no_python_on_the_row_path(spark, lake):
    stored = read_curated(spark, lake)
    for report in (
        reports.top_anomaly_hours(stored),
        reports.sensor_statistics(stored),
        reports.daily_evolution(stored),
        serving.daily_stats(stored, "humidity", as_of=utc(2024, 3, 11)),
        serving.recent_anomalies(stored),
    ):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan
    assert "TakeOrderedAndProject" in plan


def test_top_hours(spark):
    rows = [("humidity", 95.0, utc(2024, 1, 1, hour, minute), True)
            for hour, n in ((3, 2), (1, 2), (2, 5), (7, 1), (8, 1), (9, 1)) for minute in range(n)]
    rows.append(("humidity", 50.0, utc(2024, 1, 1, 20), False))
    assert tuples(reports.top_anomaly_hours(curated(spark, rows))) == [
        ("2024-01-01 02:00", 5),
        ("2024-01-01 01:00", 2),
        ("2024-01-01 03:00", 2),
        ("2024-01-01 07:00", 1),
        ("2024-01-01 08:00", 1),
    ]


def test_statistics_of_single_row(spark):
    stats = reports.sensor_statistics(curated(spark, [("humidity", 2.675, utc(2024, 1, 1), True)]))
    row = stats.first()
    assert (row["global_mean"], row["stddev_value"], str(row["anomaly_rate_pct"])) == (
        2.68, None, "100.00"
    )
    assert stats.schema["anomaly_rate_pct"].dataType.simpleString() == "decimal(27,2)"


def test_daily_stats_cut_off(spark, lake):
    stored = read_curated(spark, lake)
    as_of = datetime(2024, 3, 10, 12)
    stats = serving.daily_stats(stored, "Humidity", 2, as_of=as_of)
    # The first day is partial, and there is no upper bound.
    assert tuples(stats) == [
        ("2024-03-08", 95.8, 95.8, 95.8, 1, 1),
        ("2024-03-09", 73.4, 50.9, 95.9, 2, 1),
        ("2024-03-10", 73.5, 51.0, 96.0, 2, 1),
    ]
    recent = stored.where(
        (F.col("sensor_type") == "humidity")
        & (partition_day(stored) >= F.lit(datetime(2024, 3, 8).date()))
    )
    assert files_of(recent) == 3
    assert "make_date" in scan_of(stats).split("PartitionFilters")[1]
    assert serving.daily_stats(stored, "humidity", 2, as_of=utc(2025, 1, 1)).count() == 0
    assert serving.daily_stats(stored, "humidity").count() == 0


def test_daily_stats_ignore_nan_and_parse_text_times(spark):
    rows = [("humidity", v, utc(2024, 1, 1, h), False) for h, v in ((1, 10.0), (2, float("nan")))]
    frame = curated(spark, rows)
    expected = [("2024-01-01", 10.0, 10.0, 10.0, 1, 0)]
    assert tuples(serving.daily_stats(frame, "humidity", as_of=utc(2024, 1, 2))) == expected
    text = frame.withColumn("event_time", F.col("event_time").cast("string"))
    broken = text.withColumn("event_time", F.lit("never"))
    both = text.union(broken)
    assert tuples(serving.daily_stats(both, "humidity", as_of=utc(2024, 1, 2))) == expected


def test_recent_anomalies(spark, lake):
    stored = read_curated(spark, lake)
    recent = serving.recent_anomalies(stored, limit=4)
    assert recent.columns == list(serving.RECENT_COLUMNS)
    assert [(r["event_time"].day, r["sensor_type"]) for r in recent.collect()] == [
        (10, "temperature"), (10, "humidity"), (10, "pressure"), (9, "temperature")
    ]
    of_one = serving.recent_anomalies(stored, "Pressure", 2)
    assert [r["event_time"].day for r in of_one.collect()] == [10, 9]


@pytest.mark.parametrize("limit, as_of", [(1, 11), (9, 10), (30, 10), (500, 10), (5, 1), (7, 25)])
def test_search_by_days_gives_the_same_rows(spark, lake, limit, as_of):
    stored = read_curated(spark, lake)
    searched = serving.recent_anomalies(stored, limit=limit, as_of=utc(2024, 3, as_of))
    assert tuples(searched) == tuples(serving.recent_anomalies(stored, limit=limit))


def test_search_by_days_opens_few_files(spark, lake):
    stored = read_curated(spark, lake)
    searched = serving.recent_anomalies(stored, "humidity", 1, as_of=utc(2024, 3, 10))
    assert "make_date" in scan_of(searched).split("PartitionFilters")[1]


@pytest.mark.parametrize(
    "call",
    [
        lambda c: serving.daily_stats(c, "humidity", 0),
        lambda c: serving.daily_stats(c, "humidity", 91),
        lambda c: serving.daily_stats(c, "co2"),
        lambda c: serving.recent_anomalies(c, limit=0),
        lambda c: serving.recent_anomalies(c, limit=501),
        lambda c: serving.recent_anomalies(c, "co2"),
        lambda c: serving.latest_reading(c, "co2"),
    ],
)
def test_parameters_are_checked(spark, lake, call):
    with pytest.raises(ValueError):
        call(read_curated(spark, lake))


def test_records(spark, lake):
    stored = read_curated(spark, lake)
    records = to_records(serving.recent_anomalies(stored, "temperature", 1)).collect()
    assert records[0]["record"] == (
        '{"sensor_type":"temperature","value":41.0,"unit":"u",'
        '"event_time":"2024-03-10T18:00:00+00:00","reading_source":"site-1",'
        '"producer_anomaly":true,"is_anomaly":true}'
    )
    mixed = spark.sql("SELECT CAST(NULL AS TIMESTAMP) a, TIMESTAMP '2024-01-02 03:04:05.5' b, 1 c")
    assert to_records(mixed).first()["record"] == (
        '{"a":null,"b":"2024-01-02T03:04:05.500000+00:00","c":1}'
    )


def test_missing_zones_are_empty_and_broken_ones_an_error(spark):
    root = folder()
    assert read_raw(spark, root).schema == RAW
    assert read_curated(spark, root).count() == read_consumption(spark, root).count() == 0
    os.makedirs(f"{root}/curated/domain=iot/sensor_type=humidity/year=2024/month=1/day=1")
    with open(
        f"{root}/curated/domain=iot/sensor_type=humidity/year=2024/month=1/day=1/x.parquet", "w"
    ) as broken:
        broken.write("this is no parquet file")
    with pytest.raises(Exception, match="x.parquet"):
        read_curated(spark, root).select("value").collect()


def test_raw_zone_round_trip(spark):
    root = folder()
    arrived = F.lit("2024-06-30 23:15:00.25").cast("timestamp")
    raw = raw_envelope(messages(spark, [payload(), 'a "quoted"\ntext', None]), ingestion_time=arrived)
    write_zone(raw, root, RAW_ZONE, write_id=None)
    layout = "source=kafka/topic=sensor-events/year=2024/month=6/day=30/hour=23"
    assert glob.glob(f"{zone_path(root, RAW_ZONE)}/{layout}/*.json")
    assert sorted(tuples(read_raw(spark, root)), key=str) == sorted(tuples(raw), key=str)


def test_a_hot_partition_is_split_over_tasks(spark):
    """One sensor and day holds nearly all rows; its files come from many tasks."""
    count = 40_000
    rows = spark.range(count).select(
        F.when(F.col("id") < count - 50, "humidity").otherwise("pressure").alias("sensor_type"),
        *[
            (F.xxhash64("id", F.lit(f.name)) if f.name == "event_timestamp_ms"
             else F.sha2(F.col("id").cast("string"), 512) if f.name in ("unit", "reading_source")
             else F.lit(3) if f.name in ("month", "day") else F.lit(None)
             ).cast(f.dataType).alias(f.name)
            for f in CURATED if f.name != "sensor_type"
        ],
    )
    rows = rows.withColumns({"domain": F.lit("iot"), "year": F.lit(2024)})
    root = folder()
    previous = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_curated(rows, root, write_id="w")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", previous)
    files = {
        sensor: len(glob.glob(f"{root}/curated/*/sensor_type={sensor}/*/*/*/*/*.parquet"))
        for sensor in ("humidity", "pressure")
    }
    assert files["humidity"] > 3 and files["pressure"] == 1
    assert read_curated(spark, root).count() == count


def test_write_replaces_only_itself(spark):
    root = folder()
    first = curated(spark, [("humidity", 50.0, utc(2024, 1, 1), False)])
    second = curated(spark, [("humidity", 60.0, utc(2024, 1, 1), False)])
    write_zone(first, root, CURATED_ZONE, write_id="a")
    write_zone(second, root, CURATED_ZONE, write_id="b")
    write_zone(second, root, CURATED_ZONE, write_id="b")
    values = [row["value"] for row in read_curated(spark, root).orderBy("value").collect()]
    assert values == [50.0, 60.0]


def test_report_is_one_csv_file_in_order(spark, lake):
    out = folder()
    report = reports.daily_evolution(read_curated(spark, lake))
    for _ in range(2):
        target = save_csv(report, f"{out}/daily")
    files = glob.glob(f"{target}/*.csv")
    assert len(files) == 1
    with open(files[0]) as text:
        lines = text.read().splitlines()
    assert lines[:2] == ["event_day,mean_temperature,anomaly_count", "2024-03-01,30.1,1"]
    assert lines[1:] == sorted(lines[1:]) and len(lines) == 11


def test_report_job(spark, lake, capsys):
    out = folder()
    targets = jobs.write_reports(spark, Settings(lake_root=lake), out)
    assert set(targets) == {
        "top_anomaly_hours",
        "sensor_statistics",
        "temperature_daily_evolution",
        "partition_pruning",
    }
    assert "Sensors in figures\n------------------\nsensor_type | global_mean" in capsys.readouterr().out
    with open(glob.glob(f"{out}/sensor_statistics/*.csv")[0]) as text:
        assert text.read().splitlines()[1] == "humidity,73.05,50.1,96.0,23.09,50.00"


def test_view(spark, lake):
    register_curated_view(read_curated(spark, lake))
    assert spark.sql("SELECT count(*) FROM curated_readings WHERE day = 3").first()[0] == 6


def test_ingest_job_end_to_end(spark):
    root = folder()
    records = messages(
        spark,
        [payload(value=40.0, timestamp=millis(utc(2024, 1, 1, 0, n))) for n in range(12)],
    )
    records.write.parquet(f"{root}/log")
    settings = Settings(lake_root=f"{root}/lake", checkpoint_root=f"{root}/checkpoints")
    stream = ReplaySource(f"{root}/log").stream(spark)
    assert [f.dataType for f in stream.schema] == [f.dataType for f in KAFKA_RECORD]
    jobs.ingest(spark, settings, messages=stream, once=True, shared_batches=True)
    assert read_curated(spark, settings.lake_root).count() == 12
    assert read_consumption(spark, settings.lake_root).count() == 3
    assert curated_readings(read_raw(spark, settings.lake_root)).count() == 12
    with pytest.raises(ValueError):
        jobs.ingest(spark, Settings(), messages=stream, once=True)
