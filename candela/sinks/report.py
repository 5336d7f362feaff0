"""The comparison report as one JSON document."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candela.operators.compare import nested_report


def write_report(flat: DataFrame, path: str) -> None:
    """Write the one-row report with its four nested objects as JSON.

    The report is a single aggregated row, so one output file is written. Figures
    that are missing are explicit nulls.
    """
    nested_report(flat).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
