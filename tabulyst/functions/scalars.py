"""Column expressions: lenient casts, formats, null rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as missing in a text file, as a number, as a time.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_PATTERN = r"^\s*[+-]?\d{1,19}\s*$"
# Each shape of text has one format, so that no value is tried against all of them.
TIME_FORMATS = {
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm]$": "M/d/yyyy h:mm:ss a",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$": "M/d/yyyy H:mm:ss",
    r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$": "M/d/yyyy H:mm",
    r"^\d{1,2}/\d{1,2}/\d{4}$": "M/d/yyyy",
    r"^\d{1,2}-[A-Za-z]{3}-\d{4}$": "d-MMM-yyyy",
    r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$": "yyyy/M/d H:mm:ss",
    r"^\d{4}/\d{1,2}/\d{1,2}$": "yyyy/M/d",
    r"^\d{8}$": "yyyyMMdd",
}
ISO_TIME = r"^\s*\d{4}(-\d|\s*$)"
# A nanosecond clock spans these years; other dates are read as missing.
FIRST_YEAR, LAST_YEAR = 1678, 2261
TINY_P = 1e-300
SCIENTIFIC_BELOW = 0.001
MISSING_LABEL = "NaN"

NUMERIC_TYPES = (T.NumericType,)
TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, TIME_TYPES)


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StringType)


def is_supported(dtype: T.DataType) -> bool:
    return is_numeric(dtype) or is_time(dtype) or is_text(dtype) or isinstance(dtype, T.BooleanType)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col(quoted(name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN in a float column becomes null."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not floats:
        return df
    return df.withColumns({n: F.when(~F.isnan(col(n)), col(n)) for n in floats})


def to_number(c: Column, dtype: T.DataType) -> Column:
    """As double; text that is no number becomes null."""
    if is_text(dtype):
        return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))
    return c.cast("double") if is_numeric(dtype) else c.try_cast("double")


def to_time(c: Column, dtype: T.DataType) -> Column:
    """As timestamp without zone; text in no known format becomes null."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if not is_text(dtype):
        return c.cast("timestamp_ntz") if is_time(dtype) else F.lit(None).cast("timestamp_ntz")
    parsed = F.when(c.rlike(ISO_TIME), c.try_cast("timestamp_ntz"))
    for shape, pattern in TIME_FORMATS.items():
        # month and half-day names are read in capitals where the pattern has them
        text = F.upper(c) if pattern.endswith("a") else c
        parsed = parsed.when(
            c.rlike(shape), F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
        )
    return F.when(F.year(parsed).between(FIRST_YEAR, LAST_YEAR), parsed)


def missing(c: Column) -> Column:
    return F.when(c.isNull(), 1.0).otherwise(0.0)


def finite(c: Column) -> Column:
    """Infinity and NaN become null."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def label(c: Column) -> Column:
    """How a category value is shown."""
    return F.coalesce(c.cast("string"), F.lit(MISSING_LABEL))


def format_p(p: Column) -> Column:
    return (
        F.when(p.isNull() | F.isnan(p), "NA")
        .when(p < TINY_P, "<1e-300")
        .when(p < SCIENTIFIC_BELOW, F.format_string("%.2e", p))
        .otherwise(F.format_string("%.4f", p))
    )


def format_cell(c: Column) -> Column:
    return F.when(F.abs(c) >= 1000, F.format_string("%.2f", c)).otherwise(F.format_string("%.4f", c))
