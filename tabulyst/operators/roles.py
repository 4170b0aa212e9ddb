"""Column roles: what each column means for the analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions import names
from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col
from tabulyst.operators.dates import learn_formats, read_times
from tabulyst.operators.selection import distinct_up_to

# The shares and counts that decide a text column's role.
PARSE_SHARE = 0.8
TEXT_SHARE = 0.5
TEXT_DISTINCT = 200
CLASS_LIMIT = 20

NUMERIC, CATEGORICAL, DATETIME, TEXT = "numeric", "categorical", "datetime", "text"
UNSUPPORTED = "unsupported"


def infer_roles(df: DataFrame) -> dict[str, str]:
    """Role per column, in column order.

    Typed columns are settled by the schema. All text columns share one
    aggregation of parse rates over the whole table; distinct values are only
    counted for the columns that are neither times nor numbers.
    """
    roles: dict[str, str] = {}
    strings = []
    for f in df.schema:
        code = names.is_code_like(f.name)
        if S.is_numeric(f.dataType):
            keeps = names.mentions_coordinate(f.name) or not code
            roles[f.name] = NUMERIC if keeps else CATEGORICAL
        elif S.is_time(f.dataType):
            roles[f.name] = DATETIME
        elif S.is_text(f.dataType):
            roles[f.name] = ""
            strings.append(f.name)
        elif isinstance(f.dataType, T.BooleanType):
            roles[f.name] = CATEGORICAL
        else:
            roles[f.name] = UNSUPPORTED
    if strings:
        roles.update(_string_roles(df, strings))
    return roles


def _string_roles(df: DataFrame, columns: list[str]) -> dict[str, str]:
    text = T.StringType()
    formats = learn_formats(df, [c for c in columns if names.mentions_time(c)])
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        aggs.append(F.count(col(c)).alias(f"n{i}"))
        aggs.append(F.count(S.to_number(col(c), text)).alias(f"num{i}"))
        if names.mentions_time(c):
            aggs.append(F.count(read_times(col(c), text, formats[c])).alias(f"time{i}"))
    seen = df.agg(*aggs).first().asDict()
    roles, unsettled = {}, []
    for i, c in enumerate(columns):
        n = seen[f"n{i}"]
        if n and seen.get(f"time{i}", 0) / n > PARSE_SHARE:
            roles[c] = DATETIME
        elif n and seen[f"num{i}"] / n > PARSE_SHARE:
            roles[c] = CATEGORICAL if names.is_code_like(c) else NUMERIC
        else:
            unsettled.append(c)
    for c, distinct in distinct_up_to(df, unsettled, TEXT_DISTINCT).items():
        wide = distinct is None or distinct > TEXT_SHARE * max(1, seen["rows"])
        roles[c] = TEXT if wide else CATEGORICAL
    return roles


def roles_frame(df: DataFrame, roles: dict[str, str]) -> DataFrame:
    """The roles as a table, with what the name rules say of each column."""
    rows = [
        (
            pos, name, role, names.canonical_name(name), names.is_coordinate_name(name),
            names.is_code_like(name), names.mentions_time(name),
        )
        for pos, (name, role) in enumerate(roles.items())
    ]
    schema = (
        "position int, name string, role string, canonical string, coordinate boolean, "
        "code_like boolean, time_like boolean"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def with_role(roles: dict[str, str], role: str, within: DataFrame | None = None) -> list[str]:
    present = None if within is None else set(within.columns)
    return [c for c, r in roles.items() if r == role and (present is None or c in present)]


def task_type(df: DataFrame, target: str) -> str:
    """Numbers with many values are regressed, everything else is classified."""
    if not S.is_numeric(df.schema[target].dataType):
        return "classification"
    few = distinct_up_to(df, [target], CLASS_LIMIT)[target] is not None
    return "classification" if few else "regression"
