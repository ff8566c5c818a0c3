import json

import pytest

from gaugeline.operators.submit import (
    accepted_events,
    rejected_submissions,
    validate_submissions,
)
from gaugeline.sinks.publish import to_messages

GOOD = {"sensor": "humidity", "value": 50, "unit": "%", "source": "s"}


def body(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v is not ...})


MISSING = "Missing required field(s): "
RANGE = "Value for humidity must be between 0.0 and 100.0"
TIME = "Field 'timestamp' must be an epoch millisecond integer"
NUMERIC = "Field 'value' must be numeric"

REJECTED = [
    ("not json", "Malformed JSON request body", 400),
    ("", "Malformed JSON request body", 400),
    (None, "Malformed JSON request body", 400),
    ("[1]", "Malformed JSON request body", 400),
    ('"text"', "Malformed JSON request body", 400),
    ("null", "Malformed JSON request body", 400),
    ("{}", MISSING + "sensor, source, unit, value", 400),
    (body(unit=...), MISSING + "unit", 400),
    (body(value=..., sensor="co2"), MISSING + "value", 400),
    (body(sensor="co2", value="abc"), "Unsupported sensor type: co2", 422),
    (body(sensor=None), "Unsupported sensor type: none", 422),
    (body(sensor=12), "Unsupported sensor type: 12", 422),
    (body(value="abc", unit="K"), NUMERIC, 400),
    (body(value=None), NUMERIC, 400),
    (body(value=""), NUMERIC, 400),
    (body(value="1_"), NUMERIC, 400),
    (body(value="0x10"), NUMERIC, 400),
    (body(value="10d"), NUMERIC, 400),
    (body(value=[1]), NUMERIC, 400),
    (body(unit="C", value=500), "Invalid unit for humidity. Expected %", 422),
    (body(unit=" %"), "Invalid unit for humidity. Expected %", 422),
    (body(value=100.01), RANGE, 422),
    (body(value="nan"), RANGE, 422),
    (body(value="inf"), RANGE, 422),
    (body(value=-1, timestamp="x"), RANGE, 422),
    (body(timestamp="1.5"), TIME, 400),
    (body(timestamp="soon"), TIME, 400),
    (body(timestamp=None), TIME, 400),
    (body(timestamp=[]), TIME, 400),
]

# body, expected changes of the accepted event
ACCEPTED = [
    (body(), {}),
    (body(sensor=" HUMIDITY\t"), {}),
    (body(source="  s "), {}),
    (body(source=12), {"source": "12"}),
    (body(source=None), {"source": "None"}),
    (body(source=True), {"source": "True"}),
    (body(value="50"), {}),
    (body(value=" 5_0.0 "), {}),
    (body(value=True), {"value": 1.0}),
    (body(value=1e1), {"value": 10.0}),
    (body(value=33.336), {"value": 33.34}),
    (body(value=95.5), {"value": 95.5, "anomaly": True}),
    (body(value=90.004), {"value": 90.0, "anomaly": True}),
    (body(value=95.5, anomaly=False), {"value": 95.5, "anomaly": False}),
    (body(anomaly=True), {"anomaly": True}),
    (body(anomaly=1), {"anomaly": True}),
    (body(anomaly=0), {}),
    (body(anomaly=None, value=95), {"value": 95.0, "anomaly": False}),
    (body(anomaly="false", value=95), {"value": 95.0, "anomaly": False}),
    (body(anomaly="yes indeed"), {"anomaly": True}),
    (body(anomaly=[]), {}),
    (body(anomaly=[0]), {"anomaly": True}),
    (body(timestamp=1_779_150_201_572), {"timestamp": 1_779_150_201_572}),
    (body(timestamp="15"), {"timestamp": 15}),
    (body(timestamp=15.9), {"timestamp": 15}),
    (body(timestamp=-15.9), {"timestamp": -15}),
    (body(timestamp=True), {"timestamp": 1}),
    (body(extra={"a": 1}), {}),
]


def _validated(spark, bodies):
    frame = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    return validate_submissions(frame.coalesce(1), received_ms="7L")


def test_first_failed_check_answers(spark):
    validated = _validated(spark, [text for text, *_ in REJECTED])
    assert accepted_events(validated).count() == 0
    answers = {r["id"]: (r["message"], r["status"]) for r in rejected_submissions(validated).collect()}
    for n, (text, *answer) in enumerate(REJECTED):
        assert (text, *answers[n]) == (text, *answer)


def test_accepted_readings_are_normalised(spark):
    validated = _validated(spark, [text for text, _ in ACCEPTED])
    assert rejected_submissions(validated).count() == 0
    base = {**GOOD, "value": 50.0, "timestamp": 7, "anomaly": False}
    events = {row["id"]: row["event"].asDict() for row in validated.collect()}
    for n, (text, changes) in enumerate(ACCEPTED):
        assert (text, events[n]) == (text, {**base, **changes})


@pytest.mark.parametrize("limit", [32, 0])
def test_rule_table_may_be_joined(spark, monkeypatch, limit):
    from gaugeline.functions import rules as rules_module

    monkeypatch.setattr(rules_module, "MAX_INLINE_RULES", limit)
    validated = _validated(spark, [body(value=95), body(value=101)])
    assert [row["anomaly"] for row in accepted_events(validated).collect()] == [True]


def test_accepted_events_become_keyed_messages(spark):
    row = to_messages(accepted_events(_validated(spark, [body(value=35.87)]))).first()
    assert row["key"] == "humidity"
    assert row["value"] == (
        '{"sensor":"humidity","value":35.87,"unit":"%","timestamp":7,"source":"s","anomaly":false}'
    )


def test_bodies_are_parsed_once(spark):
    plan = accepted_events(_validated(spark, [body()]))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("parseJson(") == 1
