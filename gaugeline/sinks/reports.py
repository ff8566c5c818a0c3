"""Reports as printed tables and CSV files."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Report:
    """A query over one table whose result is small: a row a sensor, day or hour."""

    name: str
    heading: str
    query: Callable[[DataFrame], DataFrame]

    def save(self, table: DataFrame, directory: str) -> str:
        """One CSV file with a header, replacing an earlier one; returns its folder."""
        return save_csv(self.query(table), f"{directory.rstrip('/')}/{self.name}")

    def text(self, saved: str, table: DataFrame) -> str:
        """The stored file under the heading, so nothing is computed again."""
        stored = self.query(table).schema
        rows = table.sparkSession.read.schema(stored).option("header", True).csv(saved)
        lines = [" | ".join(stored.fieldNames())]
        lines += [" | ".join("" if v is None else str(v) for v in row) for row in rows.toLocalIterator()]
        return "\n".join([self.heading, "-" * len(self.heading), *lines])


def save_csv(rows: DataFrame, target: str) -> str:
    """The rows as one file. The aggregation before it stays distributed, because
    every report ends in a sort or top-k exchange."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(target)
    return target


def publish_reports(
    reports: Iterable[Report], table: DataFrame, directory: str, show: Callable[[str], None] = print
) -> dict[str, str]:
    """Save every report and show it; name -> folder."""
    folders = {}
    for report in reports:
        folders[report.name] = report.save(table, directory)
        show(report.text(folders[report.name], table))
    return folders
