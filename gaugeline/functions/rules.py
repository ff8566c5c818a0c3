"""The rule table: one row per sensor decides unit, plausibility and anomaly."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = (
    "sensor string, unit string, plausible_low double, plausible_high double, "
    "anomaly_below double, anomaly_above double"
)

# Above this many rules a CASE chain costs more per row than a hash lookup.
MAX_INLINE_RULES = 32
# Rule rows are about 100 bytes, so this bounds a broadcast to some 20 MB.
MAX_BROADCAST_RULES = 200_000


@dataclass(frozen=True)
class SensorRule:
    """Plausible bounds are inclusive, anomaly bounds strict; None = no bound."""

    sensor: str
    unit: str
    plausible_low: float
    plausible_high: float
    anomaly_below: float | None = None
    anomaly_above: float | None = None


# Fixed values.
DEFAULT_RULES = (
    SensorRule("temperature", "C", -50.0, 80.0, None, 35.0),
    SensorRule("humidity", "%", 0.0, 100.0, None, 90.0),
    SensorRule("pressure", "hPa", 900.0, 1100.0, 990.0, 1030.0),
)


class RuleSet:
    def __init__(self, rules: Iterable[SensorRule] = DEFAULT_RULES):
        self.rules = tuple(rules)
        self.by_sensor = {rule.sensor: rule for rule in self.rules}
        if len(self.by_sensor) != len(self.rules):
            raise ValueError("every sensor may have one rule only")

    def __len__(self) -> int:
        return len(self.rules)

    def require(self, sensor: str) -> str:
        """Normalise a sensor given as a parameter; unknown sensors are an error."""
        name = sensor.strip().lower()
        if name not in self.by_sensor:
            raise ValueError(f"Unsupported sensor type: {name}")
        return name

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([astuple(rule) for rule in self.rules], RULE_SCHEMA)

    def sensors(self, spark: SparkSession) -> DataFrame:
        """The sensor/unit dimension, in rule order."""
        return spark.createDataFrame(
            [(rule.sensor, rule.unit) for rule in self.rules], "sensor string, unit string"
        )

    # The rules as SQL expressions over the named columns. One expression text
    # costs one call to the JVM, however many rules it holds.

    def known_sql(self, sensor: str) -> str:
        """NULL only for a NULL sensor."""
        return f"{sensor} IN ({', '.join(map(sql_text, self.by_sensor))})"

    def plausible_sql(self, sensor: str, value: str) -> str:
        """False for an unknown sensor and for NaN, NULL exactly for a NULL input."""
        inside = _any(
            f"{sensor} = {sql_text(rule.sensor)} AND {value} BETWEEN "
            f"{sql_double(rule.plausible_low)} AND {sql_double(rule.plausible_high)}"
            for rule in self.rules
        )
        return f"CASE WHEN {sensor} IS NOT NULL AND {value} IS NOT NULL THEN {inside} END"

    def anomaly_sql(self, sensor: str, value: str) -> str:
        """Never NULL; an unknown sensor or a NULL value is no anomaly."""
        bounds = (
            f"{sensor} = {sql_text(rule.sensor)} AND {value} {sign} {sql_double(bound)}"
            for rule in self.rules
            for sign, bound in (("<", rule.anomaly_below), (">", rule.anomaly_above))
            if bound is not None
        )
        return f"coalesce({_any(bounds)}, false)"

    def unit_sql(self, sensor: str) -> str:
        """NULL for an unknown sensor."""
        return _case(sensor, {rule.sensor: sql_text(rule.unit) for rule in self.rules})

    def bounds_sql(self, sensor: str) -> str:
        """The plausible range in words, NULL for an unknown sensor."""
        return _case(
            sensor,
            {
                rule.sensor: sql_text(range_text(rule))
                for rule in self.rules
            },
        )

    def judge(self, readings: DataFrame, sensor: str, value: str) -> DataFrame:
        """Add ``known``, ``plausible``, ``is_anomaly``, ``rule_unit`` and ``rule_range``.

        ``known`` is NULL for a NULL sensor, ``plausible`` for a NULL sensor or value,
        unit and range (in words) for a sensor without rule, however many rules there
        are. A short rule table becomes a chain of comparisons inside the scan stage.
        A longer one is joined: broadcast while its length proves it small, as a
        plain join that adaptive execution may split beyond that.
        """
        if len(self) <= MAX_INLINE_RULES:
            return readings.selectExpr(
                "*",
                f"{self.known_sql(sensor)} AS known",
                f"{self.plausible_sql(sensor, value)} AS plausible",
                f"{self.anomaly_sql(sensor, value)} AS is_anomaly",
                f"{self.unit_sql(sensor)} AS rule_unit",
                f"{self.bounds_sql(sensor)} AS rule_range",
            )
        # The range is worded here, as numbers print differently in SQL.
        rows = [(*astuple(rule), range_text(rule)) for rule in self.rules]
        table = (
            readings.sparkSession.createDataFrame(rows, RULE_SCHEMA + ", rule_range string")
            .withColumnRenamed("sensor", "rule_sensor")
            .withColumnRenamed("unit", "rule_unit")
        )
        if len(self) <= MAX_BROADCAST_RULES:
            table = F.broadcast(table)
        joined = readings.join(table, F.col(sensor) == F.col("rule_sensor"), "left")
        return joined.selectExpr(
            *readings.columns,
            f"CASE WHEN {sensor} IS NOT NULL THEN rule_sensor IS NOT NULL END AS known",
            f"""CASE WHEN {sensor} IS NOT NULL AND {value} IS NOT NULL
              THEN coalesce({value} BETWEEN plausible_low AND plausible_high, false) END AS plausible""",
            f"coalesce({value} < anomaly_below, false) OR coalesce({value} > anomaly_above, false)"
            " AS is_anomaly",
            "rule_unit",
            "rule_range",
        )


def range_text(rule: SensorRule) -> str:
    return f"between {rule.plausible_low} and {rule.plausible_high}"


def sql_text(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_double(number: float) -> str:
    return f"CAST('{float(number)!r}' AS DOUBLE)"


def _any(conditions: Iterable[str]) -> str:
    return " OR ".join(f"({condition})" for condition in conditions) or "false"


def _case(key: str, branches: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {sql_text(name)} THEN {result}" for name, result in branches.items())
    return f"CASE {key} {whens} END" if branches else "CAST(NULL AS STRING)"
