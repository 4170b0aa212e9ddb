"""Date features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col
from tabulyst.operators import roles as R

# The endings of the added columns; Monday is weekday 0.
PARTS = {"year": F.year, "month": F.month, "dow": F.weekday}


def date_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_{p}": fn(col(c)) for c in columns for p, fn in PARTS.items()})


def add_features(df: DataFrame, roles: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """Year, month and weekday of every time column, and the names added."""
    times = [c for c in R.with_role(roles, R.DATETIME, df) if S.is_time(df.schema[c].dataType)]
    if not times:
        return df, []
    return date_features(df, times), [f"{c}_{p}" for c in times for p in PARTS]
