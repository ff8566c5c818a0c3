"""Strict validation of submitted readings (JSON text in a column ``body``).

A body is parsed once into a VARIANT, which keeps the difference between an
absent key, ``null``, a number and the same number as text. Each rule is an
expression, and the first that fails gives message and status.

Known differences from a Python validator: rounding of ties goes up instead of
to even; ``anomaly`` given as text is read as a boolean word; a timestamp beyond
64 bits is refused; ``NaN`` literals and repeated keys make a body malformed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeline.functions.rules import RuleSet, sql_text

# Fixed values.
REQUIRED_FIELDS = ("sensor", "source", "unit", "value")
MALFORMED = "Malformed JSON request body"
VALUE_NOT_NUMERIC = "Field 'value' must be numeric"
TIMESTAMP_NOT_INTEGER = "Field 'timestamp' must be an epoch millisecond integer"
BAD_REQUEST = 400
UNPROCESSABLE = 422

NOW = "unix_millis(current_timestamp())"

_FIELDS = (*REQUIRED_FIELDS, "timestamp", "anomaly")
_SPACE = r"' \t\n\r\u000b\f'"
_DIGITS = r"\\d+(_\\d+)*"
_INTEGER_TEXT = rf"'^\\s*[+-]?{_DIGITS}\\s*$'"
_NUMBER_TEXT = (
    rf"'(?i)^\\s*[+-]?(({_DIGITS}(\\.({_DIGITS})?)?|\\.{_DIGITS})(e[+-]?{_DIGITS})?"
    r"|inf(inity)?|nan)\\s*$'"
)


def validate_submissions(
    submissions: DataFrame, rules: RuleSet | None = None, *, received_ms: str = NOW
) -> DataFrame:
    """Every submission with either ``event`` or ``error`` (message, status).

    ``received_ms`` is the SQL expression of the time given to readings without
    one. Plausibility and the default flag look at the value before rounding.
    """
    rules = rules or RuleSet()
    own = submissions.columns
    judged = rules.judge(_read(submissions), "sensor", "number")
    answered = _once(judged, judged.columns, error=_first_error())
    event = f"""named_struct(
      'sensor', sensor, 'value', round(number, 2), 'unit', rule_unit,
      'timestamp', coalesce(timestamp, {received_ms}), 'source', source,
      'anomaly', coalesce(flag, is_anomaly))"""
    return answered.selectExpr(*own, f"CASE WHEN error IS NULL THEN {event} END AS event", "error")


def accepted_events(validated: DataFrame) -> DataFrame:
    """EVENT rows ready to publish."""
    return validated.where("error IS NULL").select("event.*")


def rejected_submissions(validated: DataFrame) -> DataFrame:
    """Refused submissions with the first failed check."""
    own = [name for name in validated.columns if name not in ("event", "error")]
    return validated.where("error IS NOT NULL").select(*own, "error.*")


def _first_error() -> str:
    """Struct of the first failed check; later ones may rely on earlier ones."""
    checks = [
        ("NOT coalesce(is_object, false)", sql_text(MALFORMED), BAD_REQUEST),
        ("missing <> ''", "concat('Missing required field(s): ', missing)", BAD_REQUEST),
        ("NOT known", "concat('Unsupported sensor type: ', sensor)", UNPROCESSABLE),
        ("number IS NULL", sql_text(VALUE_NOT_NUMERIC), BAD_REQUEST),
        (
            "unit <> rule_unit",
            "concat('Invalid unit for ', sensor, '. Expected ', rule_unit)",
            UNPROCESSABLE,
        ),
        (
            "NOT plausible",
            "concat('Value for ', sensor, ' must be ', rule_range)",
            UNPROCESSABLE,
        ),
        (
            "timestamp_kind IS NOT NULL AND timestamp IS NULL",
            sql_text(TIMESTAMP_NOT_INTEGER),
            BAD_REQUEST,
        ),
    ]
    whens = "\n".join(
        f"WHEN {failed} THEN named_struct('message', {message}, 'status', {status})"
        for failed, message, status in checks
    )
    return f"CASE {whens} END"


def _read(submissions: DataFrame) -> DataFrame:
    """The typed fields of each body; NULL where the given value does not fit."""
    own = submissions.columns
    parsed = _once(submissions, own, document="try_parse_json(body)")
    values = _once(
        parsed,
        [*own, "document"],
        is_object="startswith(schema_of_variant(document), 'OBJECT')",
        **{name: f"try_variant_get(document, '$.{name}', 'variant')" for name in _FIELDS},
    )
    kinds = _once(
        values,
        [*own, "document", "is_object"],
        **{f"{name}_kind": f"schema_of_variant({name})" for name in _FIELDS},
        **{f"{name}_text": f"try_variant_get({name}, '$', 'string')" for name in _FIELDS},
    )
    missing = ", ".join(f"IF({name}_kind IS NULL, '{name}', NULL)" for name in REQUIRED_FIELDS)
    return _once(
        kinds,
        [*own, "is_object", "timestamp_kind"],
        missing=f"concat_ws(', ', {missing})",
        sensor=f"lower({_stripped('sensor')})",
        number=_number("value"),
        unit=_as_text("unit"),
        source=_stripped("source"),
        timestamp=_integer("timestamp"),
        flag=_truth("anomaly"),
    )


def _once(frame: DataFrame, keep: list[str], **columns: str) -> DataFrame:
    """Compute columns exactly once, whatever later steps do with them.

    A plain projection would be merged into every later use of its columns.
    """
    fields = ", ".join(f"'{name}', {expression}" for name, expression in columns.items())
    return frame.selectExpr(*keep, f"inline(array(named_struct({fields})))")


def _is_number(name: str) -> str:
    return f"({name}_kind IN ('BIGINT', 'DOUBLE') OR startswith({name}_kind, 'DECIMAL'))"


def _as_text(name: str) -> str:
    """The value as a string, with ``null`` and booleans spelled as words."""
    return f"""CASE {name}_kind WHEN 'STRING' THEN {name}_text WHEN 'VOID' THEN 'None'
      WHEN 'BOOLEAN' THEN initcap({name}_text) ELSE {name}_text END"""


def _stripped(name: str) -> str:
    return f"trim(BOTH {_SPACE} FROM {_as_text(name)})"


def _number(name: str) -> str:
    """NULL unless the value is a number, a boolean or the text of a number."""
    return f"""CASE WHEN {_is_number(name)} THEN try_cast({name}_text AS DOUBLE)
      WHEN {name}_kind = 'STRING' AND {name}_text RLIKE {_NUMBER_TEXT}
        THEN try_cast(replace({name}_text, '_') AS DOUBLE)
      WHEN {name}_kind = 'BOOLEAN' THEN CAST({name}_text = 'true' AS DOUBLE) END"""


def _integer(name: str) -> str:
    """As a number; fractions of a number are cut, of a text refused."""
    return f"""CASE WHEN {_is_number(name)} THEN try_variant_get(document, '$.{name}', 'bigint')
      WHEN {name}_kind = 'STRING' AND {name}_text RLIKE {_INTEGER_TEXT}
        THEN try_cast(replace({name}_text, '_') AS BIGINT)
      WHEN {name}_kind = 'BOOLEAN' THEN CAST({name}_text = 'true' AS BIGINT) END"""


def _truth(name: str) -> str:
    """NULL where absent; ``null`` and what is empty or 0 count as false."""
    return f"""CASE WHEN {name}_kind = 'BOOLEAN' THEN {name}_text = 'true'
      WHEN {_is_number(name)} THEN try_cast({name}_text AS DOUBLE) <> 0
      WHEN {name}_kind = 'STRING'
        THEN coalesce(try_cast({name}_text AS BOOLEAN), {name}_text <> '')
      WHEN {name}_kind IS NOT NULL
        THEN coalesce({name}_text, 'null') NOT IN ('null', '[]', '{{}}') END"""
