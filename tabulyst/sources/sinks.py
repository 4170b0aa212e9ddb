"""Sinks: the parts of an analysis as JSON, a subset of a table as CSV."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_parts(parts: Mapping[str, DataFrame], folder: str) -> None:
    """Each part of an analysis becomes a folder of JSON lines."""
    for name, df in parts.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
