from datetime import datetime

import pytest
from builders import messages, payload, tuples, utc
from pyspark.sql import functions as F

from gaugeline.functions.rules import RuleSet
from gaugeline.operators import decode as D
from gaugeline.operators.envelope import raw_envelope
from gaugeline.schemas import CURATED, RAW

VALID = payload()

# payload, reason (None = kept)
CASES = [
    (VALID, None),
    (None, D.NO_PAYLOAD),
    ("", D.NO_PAYLOAD),
    ('{"sensor":"temperature","value":2', D.SENSOR_MISSING),
    ("plain text", D.SENSOR_MISSING),
    ("[]", D.SENSOR_MISSING),
    (f"[{VALID},{VALID}]", D.SENSOR_MISSING),
    ("null", D.SENSOR_MISSING),
    ("{}", D.SENSOR_MISSING),
    (payload(sensor=None), D.SENSOR_MISSING),
    (payload(sensor="co2"), D.SENSOR_UNSUPPORTED),
    (payload(sensor="Temperature"), D.SENSOR_UNSUPPORTED),
    (payload(value="20.5"), D.VALUE_MISSING),
    (payload(value="abc"), D.VALUE_MISSING),
    (payload(value=None), D.VALUE_MISSING),
    (payload(timestamp=...), D.TIMESTAMP_MISSING),
    (payload(timestamp=1.5), D.TIMESTAMP_MISSING),
    (payload(timestamp=9_000_000_000_000_000_000), D.TIMESTAMP_OUT_OF_RANGE),
    (payload(timestamp=253_402_300_800_000), D.TIMESTAMP_OUT_OF_RANGE),
    (payload(timestamp=253_402_300_799_999), None),
    (payload(timestamp=-62_135_596_800_001), D.TIMESTAMP_OUT_OF_RANGE),
    (payload(value=80.01), D.VALUE_IMPLAUSIBLE),
    ('{"sensor":"temperature","value":NaN,"timestamp":0}', D.VALUE_IMPLAUSIBLE),
    # Neither unit nor source nor the producer's flag are checked.
    (payload(unit="K", source=None, anomaly="maybe"), None),
    (payload(timestamp=-1500), None),
]


@pytest.fixture(scope="module")
def raw(spark):
    return raw_envelope(messages(spark, [text for text, _ in CASES])).cache()


def test_rejected_messages_carry_the_first_reason(raw):
    found = {row["kafka_offset"]: row["reject_reason"] for row in D.rejected(raw).collect()}
    assert found == {n: reason for n, (_, reason) in enumerate(CASES) if reason}


def test_curated_is_the_complement_of_rejected(raw):
    kept = {row["kafka_offset"] for row in D.curated_readings(raw).collect()}
    assert kept == {n for n, (_, reason) in enumerate(CASES) if reason is None}


def test_counts_per_reason(raw):
    counts = dict(tuples(D.reject_counts(D.rejected(raw))))
    assert counts[D.SENSOR_MISSING] == 7
    assert sum(counts.values()) == sum(reason is not None for _, reason in CASES)


def test_columns_and_types(raw):
    def shape(schema):
        return [(field.name, field.dataType) for field in schema]

    assert shape(raw.schema) == shape(RAW)
    assert shape(D.curated_readings(raw).schema) == shape(CURATED)


@pytest.mark.parametrize(
    "ms, expected",
    [
        (1_779_150_201_572, "2026-05-19 00:23:21"),
        (999, "1970-01-01 00:00:00"),
        (-1500, "1969-12-31 23:59:59"),
        (-999, "1970-01-01 00:00:00"),
    ],
)
def test_event_time_is_cut_to_seconds_toward_zero(spark, ms, expected):
    rows = D.curated_readings(raw_envelope(messages(spark, [payload(timestamp=ms)])))
    assert rows.select(F.col("event_time").cast("string")).first()[0] == expected


def test_date_parts(spark):
    arrived = F.lit("2024-06-30 23:59:59.5").cast("timestamp")
    raw = raw_envelope(
        messages(spark, [payload(timestamp=1_779_150_201_572)]), ingestion_time=arrived
    )
    row = raw.first()
    assert (row["year"], row["month"], row["day"], row["hour"]) == (2024, 6, 30, 23)
    assert (row["source"], row["topic"]) == ("kafka", "sensor-events")
    row = D.curated_readings(raw).first()
    assert (row["domain"], row["year"], row["month"], row["day"]) == ("iot", 2026, 5, 19)


def test_future_skew_is_optional(spark):
    arrived = utc(2024, 1, 1)
    late = payload(timestamp=int(utc(2024, 1, 1, 2).timestamp() * 1000))
    raw = raw_envelope(messages(spark, [late], arrived=arrived))
    assert D.curated_readings(raw).count() == 1
    assert D.curated_readings(raw, max_future_skew="1 hour").count() == 0
    refused = D.rejected(raw, max_future_skew="1 hour").first()
    assert refused["reject_reason"] == D.TIMESTAMP_OUT_OF_RANGE


def test_json_is_parsed_once_per_row(spark, raw):
    """A second parser in the plan would double the cost of the whole job."""
    fresh = raw_envelope(messages(spark, [VALID]))
    for frame in (D.curated_readings(fresh), D.rejected(fresh)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
        assert "Python" not in plan


def test_long_rule_tables_give_the_same_readings(spark, raw, monkeypatch):
    from gaugeline.functions import rules as rules_module

    inline = set(tuples(D.curated_readings(raw).drop("ingestion_time")))
    monkeypatch.setattr(rules_module, "MAX_INLINE_RULES", 0)
    joined = set(tuples(D.curated_readings(raw, RuleSet()).drop("ingestion_time")))
    assert joined == inline
    reasons = {row["kafka_offset"]: row["reject_reason"] for row in D.rejected(raw).collect()}
    assert reasons == {n: reason for n, (_, reason) in enumerate(CASES) if reason}


def test_replays_are_dropped_by_log_position(spark):
    raw = raw_envelope(messages(spark, [VALID, VALID]))
    twice = raw.union(raw)
    assert twice.count() == 4
    assert D.drop_replayed(twice).count() == 2
    assert D.drop_replayed(D.curated_readings(twice)).count() == 2


def test_datetime_type(raw):
    assert isinstance(D.curated_readings(raw).first()["event_time"], datetime)
