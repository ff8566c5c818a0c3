"""Sources and sinks of messages, bounded scans, settings."""

import os

import pytest
from builders import messages, payload, tuples
from pyspark.errors import AnalysisException

from gaugeline.config import Settings, split_servers
from gaugeline.operators.envelope import raw_envelope
from gaugeline.plans import serving
from gaugeline.session import apply_runtime_settings, clear_scratch, scratch_dir
from gaugeline.sinks.publish import publish_options
from gaugeline.sources.messages import KafkaSource
from gaugeline.sources.tail import peek, tail


def log(spark, *partitions):
    """Raw rows; every argument is the payload list of one partition."""
    frames = [
        messages(spark, texts, partition=n, first_offset=10) for n, texts in enumerate(partitions)
    ]
    union = frames[0]
    for frame in frames[1:]:
        union = union.union(frame)
    return raw_envelope(union)


WAYS = [
    {},
    {"max_literal_ends": 0},
    {"max_literal_ends": 0, "max_broadcast_ends": 0},
]


@pytest.mark.parametrize("way", WAYS)
def test_tail_is_by_offset_and_partition(spark, way):
    raw = log(spark, [payload()] * 7, [payload()] * 2)
    # Offsets with a gap: the tail counts offsets, not rows. Copies are kept.
    raw = raw.where("kafka_offset <> 14")
    raw = raw.union(raw.where("kafka_offset = 16"))
    found = sorted((r["kafka_partition"], r["kafka_offset"]) for r in tail(raw, 3, **way).collect())
    assert found == [(0, 15), (0, 16), (0, 16), (1, 10), (1, 11)]
    assert tail(raw, 3, **way).columns == raw.columns


def test_tail_of_nothing(spark):
    assert tail(log(spark, [payload()]).where("false")).count() == 0


def test_latest_reading(spark):
    raw = log(
        spark,
        [payload(timestamp=900, value=1.0)] + [payload(timestamp=5, value=2.0)] * 3,
        [payload(timestamp=5, value=3.0), payload(sensor="humidity", timestamp=99)],
        [payload(timestamp=..., value=4.0), payload(timestamp=-1), "broken"],
    )
    # Without validation; the first of equal times wins; the rest is out of reach.
    row = serving.latest_reading(raw, "Temperature", lookback=3).first()
    assert (row["timestamp"], row["value"]) == (5, 2.0)
    assert row["_kafka"].asDict() == {"partition": 0, "offset": 11}
    assert serving.latest_reading(raw, "temperature").first()["timestamp"] == 900
    assert serving.latest_reading(raw, "pressure").count() == 0


def test_missing_timestamp_counts_as_zero(spark):
    raw = log(spark, [payload(timestamp=-1), payload(timestamp=..., value=4.0)])
    assert serving.latest_reading(raw, "temperature").first()["value"] == 4.0


def test_peek(spark):
    raw = log(spark, [payload(value=20.25), "broken"], [payload()])
    assert tuples(peek(raw, 2, ordered=True)) == [
        (
            0,
            10,
            "temperature",
            '{"anomaly":false,"sensor":"temperature","source":"site-1","timestamp":0,"unit":"C","value":20.25}',
        ),
        (0, 11, "temperature", "broken"),
    ]
    assert peek(raw).count() == 3
    plan = peek(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "TakeOrdered" not in plan


def test_run_summary(spark):
    events = spark.createDataFrame([(True,), (False,), (False,), (False,)], "anomaly boolean")
    assert tuples(serving.run_summary(events)) == [(4, 1, 0.25)]
    assert tuples(serving.run_summary(events.where("false"))) == [(0, 0, 0.0)]


def test_sensor_units_lists_sensors_without_readings(spark):
    readings = spark.createDataFrame([("humidity",), ("humidity",)], "sensor_type string")
    assert tuples(serving.sensor_units(spark)) == [
        ("temperature", "C"), ("humidity", "%"), ("pressure", "hPa")
    ]
    assert sorted(tuples(serving.reading_counts(readings))) == [
        ("humidity", "%", 2),
        ("pressure", "hPa", 0),
        ("temperature", "C", 0),
    ]


def test_kafka_options():
    source = KafkaSource.from_settings(
        Settings(bootstrap_servers=("a:1", "b:2")), min_partitions=64, max_offsets_per_trigger=1000
    )
    assert source.options(streaming=True) == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "sensor-events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
        "maxOffsetsPerTrigger": "1000",
    }
    bounded = KafkaSource("t", ("a:1",), ending_offsets="latest").options(streaming=False)
    assert bounded["endingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in bounded


def test_publish_options():
    options = publish_options(Settings(topic="t", bootstrap_servers=("a:1",)))
    assert options["topic"] == "t" and options["kafka.acks"] == "all"
    assert options["kafka.max.in.flight.requests.per.connection"] == "1"


def test_kafka_without_connector_is_an_analysis_error(spark):
    with pytest.raises(AnalysisException):
        KafkaSource("t", ("a:1",)).batch(spark)


def test_settings():
    assert split_servers(" a:1, ,b:2,") == ("a:1", "b:2")
    settings = Settings.from_env(
        {"KAFKA_TOPIC": "t", "KAFKA_BOOTSTRAP_SERVERS": "x:1,y:2", "DATALAKE_ROOT": "/lake"}
    )
    assert (settings.topic, settings.bootstrap_servers, settings.lake_root) == (
        "t", ("x:1", "y:2"), "/lake"
    )
    assert (settings.checkpoint_root, settings.shuffle_partitions) == (None, 6)


def test_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    apply_runtime_settings(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(f"{shared}/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    made = scratch_dir(spark, "y")
    spark.range(1).write.parquet(made)
    clear_scratch(spark)
    assert not os.path.exists(made.removeprefix("file:"))
