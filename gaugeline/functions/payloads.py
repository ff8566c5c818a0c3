"""JSON text of messages and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.times import iso_text
from gaugeline.schemas import EVENT


def encode(*columns: Column | str) -> Column:
    """Compact JSON object of the given columns, in their order."""
    return F.to_json(F.struct(*columns))


def decode_event(payload: Column) -> Column:
    """Struct of EVENT fields.

    NULL and empty text give a NULL struct; other malformed text, and fields of
    the wrong type, give NULL fields.
    """
    return F.from_json(payload, EVENT)


def sorted_keys(payload: Column) -> Column:
    """The same JSON with its keys in order; text that is not JSON is kept."""
    return F.coalesce(F.to_json(F.try_parse_json(payload)), payload)


def to_records(frame: DataFrame) -> DataFrame:
    """One JSON object per row, in a column ``record``.

    NULL stays visible as ``null`` and timestamps become ISO-8601 text.
    """
    fields = [
        iso_text(frame[field.name]).alias(field.name)
        if isinstance(field.dataType, T.TimestampType)
        else frame[field.name]
        for field in frame.schema.fields
    ]
    return frame.select(
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("record")
    )
