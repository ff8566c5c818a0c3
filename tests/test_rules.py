import math

import pytest
from builders import tuples

from gaugeline.functions import rules as rules_module
from gaugeline.functions.rules import DEFAULT_RULES, RuleSet, SensorRule

# sensor, value, known, plausible, anomaly
CASES = [
    ("temperature", -50.01, True, False, False),
    ("temperature", -50.0, True, True, False),
    ("temperature", 15.0, True, True, False),
    ("temperature", 35.0, True, True, False),
    ("temperature", 35.01, True, True, True),
    ("temperature", 80.0, True, True, True),
    ("temperature", 80.01, True, False, True),
    ("humidity", -0.01, True, False, False),
    ("humidity", 0.0, True, True, False),
    ("humidity", 90.0, True, True, False),
    ("humidity", 90.01, True, True, True),
    ("humidity", 100.0, True, True, True),
    ("humidity", 100.01, True, False, True),
    ("pressure", 899.99, True, False, True),
    ("pressure", 900.0, True, True, True),
    ("pressure", 989.99, True, True, True),
    ("pressure", 990.0, True, True, False),
    ("pressure", 1030.0, True, True, False),
    ("pressure", 1030.01, True, True, True),
    ("pressure", 1100.0, True, True, True),
    ("pressure", 1100.01, True, False, True),
    ("Temperature", 20.0, False, False, False),
    ("co2", 20.0, False, False, False),
    ("temperature", math.nan, True, False, True),
    ("temperature", None, True, None, False),
    (None, 20.0, None, None, False),
]


def _padding(count):
    return [SensorRule(f"other-{n}", "u", 0.0, 1.0) for n in range(count)]


@pytest.mark.parametrize("way", ["inline", "broadcast", "join"])
def test_boundaries(spark, monkeypatch, way):
    monkeypatch.setattr(rules_module, "MAX_INLINE_RULES", 10)
    monkeypatch.setattr(rules_module, "MAX_BROADCAST_RULES", 1 if way == "join" else 100)
    rules = RuleSet(DEFAULT_RULES if way == "inline" else [*DEFAULT_RULES, *_padding(20)])
    frame = spark.createDataFrame([case[:2] for case in CASES], "sensor string, value double")
    judged = rules.judge(frame, "sensor", "value")
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert ("Join" in plan) == (way != "inline")
    assert ("Broadcast" in plan) == (way == "broadcast")

    def view(rows):
        # NaN is compared as text.
        return sorted(
            (str(s), str(v), k, p, a) for s, v, k, p, a, *_ in rows
        )

    assert view(tuples(judged)) == view(CASES)
    words = {r["sensor"]: (r["rule_unit"], r["rule_range"]) for r in judged.collect()}
    assert words["pressure"] == ("hPa", "between 900.0 and 1100.0")
    assert words["co2"] == words[None] == (None, None)


def test_unit_and_range_words(spark):
    rules = RuleSet()
    frame = spark.createDataFrame([("pressure",), ("co2",)], "sensor string")
    result = frame.selectExpr(rules.unit_sql("sensor"), rules.bounds_sql("sensor"))
    assert tuples(result) == [("hPa", "between 900.0 and 1100.0"), (None, None)]


def test_sensor_list_is_in_rule_order(spark):
    assert tuples(RuleSet().sensors(spark)) == [
        ("temperature", "C"),
        ("humidity", "%"),
        ("pressure", "hPa"),
    ]


def test_new_sensor_is_one_rule(spark):
    rules = RuleSet([*DEFAULT_RULES, SensorRule("co2's", "ppm", 0.0, 5000.0, None, 1000.0)])
    frame = spark.createDataFrame([("co2's", 1200.0)], "sensor string, value double")
    assert tuples(rules.judge(frame, "sensor", "value")) == [
        ("co2's", 1200.0, True, True, True, "ppm", "between 0.0 and 5000.0")
    ]


def test_parameters():
    rules = RuleSet()
    assert rules.require(" Humidity ") == "humidity"
    with pytest.raises(ValueError, match="Unsupported sensor type: co2"):
        rules.require("CO2")
    with pytest.raises(ValueError):
        RuleSet([DEFAULT_RULES[0], DEFAULT_RULES[0]])
