"""Date formats learnt from a whole column.

Each value has a shape: runs of digits and of letters are one sign each. One aggregation counts the
shapes of a column and votes on the order of day and month: a first number over 12 can only
be a day, and so can a second one. A column reads all dates with one separator in one order. Without
votes a point means day first; other separators keep the usual order. Values in
other shapes are read as before.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions import scalars as S
from tabulyst.functions.scalars import col

#: Characters of a date, and shapes of a column that are looked at, at most; others are misses.
LONGEST, SHAPES = 40, 32
#: Fixed value: where two-digit years turn.
PIVOT = 69
#: What a shape begins with, and the time that may follow.
_NUMBERS = re.compile(r"^9([./ -])9\1(?:9)(.*)$")
_NAMED = {re.compile(r"^9\.?([ -])A\.?\1(9)(.*)$"): "d{dot}{sep}{month}{sep}yyyy", re.compile(r"^A\.? (9),? 9(.*)$"): "{month} d{comma} yyyy"}
_TIMES = {"": "", "9:9": "H:mm", "9:9:9": "H:mm:ss", "9:9 A": "h:mm a", "9:9:9 A": "h:mm:ss a"}

Formats = dict[str, str]


def _shape(x: Column) -> Column:
    return F.when(F.char_length(x) <= LONGEST, F.regexp_replace(F.regexp_replace(F.trim(x), "[0-9]+", "9"), r"\p{L}+", "A"))


def _time(rest: str) -> str | None:
    """The pattern of what follows a date, or null if that is no time."""
    lead = rest[:1] if rest[:1] in (" ", "T") else ""
    if lead == "T" or (rest.startswith("A") and not lead):
        return None
    found = _TIMES.get(rest[len(lead):])
    return None if found is None else (" " + found if found else "")


def _named(shape: str) -> list[str]:
    """Patterns of a shape with a month's name, short or whole."""
    for pattern, form in _NAMED.items():
        if (m := pattern.match(shape)) and (time := _time(m.groups()[-1])) is not None:
            sep = m.group(1) if m.group(1) in " -" else " "
            of = {"sep": sep, "dot": "." if shape.startswith("9.") else "", "comma": "," if "," in shape else ""}
            return [form.format(month=month, **of) + time for month in ("MMM", "MMMM")]
    return []


def learn_formats(df: DataFrame, columns: Sequence[str]) -> dict[str, Formats]:
    """``{column: {shape: pattern}}`` of text columns, from one aggregation over whole columns.
    Patterns that only differ in the month's length are joined by a bar."""
    columns = list(columns)
    if not columns:
        return {}
    cells = [x for i, c in enumerate(columns) for x in (F.lit(i), col(c).cast("string"))]
    long = df.select(F.stack(F.lit(len(columns)), *cells).alias("position", "x")).select("position", "x", _shape(F.col("x")).alias("shape"))
    part = [F.regexp_extract("x", r"^\s*(\d+)[./ -](\d+)[./ -](\d+)", k) for k in (1, 2, 3)]
    votes = long.filter("shape is not null").groupBy("position", "shape").agg(
        F.count("*").alias("n"), F.count_if(F.char_length(part[0]) == 4).alias("year_first"), F.count_if(F.char_length(part[2]) == 2).alias("short"),
        F.count_if((F.char_length(part[0]) <= 2) & (part[0].try_cast("int") > 12)).alias("day_first"),
        F.count_if(part[1].try_cast("int") > 12).alias("day_second"),
    )
    # the commonest shapes of each column: a bounded number
    order = W.partitionBy("position").orderBy(F.desc("n"), "shape")
    top = votes.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SHAPES)
    found: dict[str, Formats] = {c: {} for c in columns}
    seen: dict[tuple[str, str], list] = {}
    for r in top.collect():
        c = columns[r["position"]]
        if (m := _NUMBERS.match(r["shape"])) and _time(m.group(2)) is not None:
            seen.setdefault((c, m.group(1)), []).append((r, _time(m.group(2))))
        elif patterns := _named(r["shape"]):
            found[c][r["shape"]] = "|".join(patterns)
    for (c, sep), rows in seen.items():
        first, second = (sum(r[k] for r, _ in rows) for k in ("day_first", "day_second"))
        day_first = first > second or (first == second and sep == ".")
        for r, time in rows:
            year = "yy" if 2 * r["short"] > r["n"] else "yyyy"
            if 2 * r["year_first"] > r["n"]:
                found[c][r["shape"]] = f"yyyy{sep}M{sep}d{time}"
            else:
                found[c][r["shape"]] = (f"d{sep}M{sep}{year}" if day_first else f"M{sep}d{sep}{year}") + time
    return found


def _read(text: Column, pattern: str) -> Column:
    """Times by one pattern. Two digits of a year from PIVOT on are of the last century."""
    # half-day names are read in capitals
    time = F.try_to_timestamp(F.upper(text) if pattern.endswith("a") else text, F.lit(pattern)).cast("timestamp_ntz")
    if "yy" not in pattern.replace("yyyy", ""):
        return time
    return F.when(F.year(time) >= 2000 + PIVOT, time - F.make_ym_interval(F.lit(100))).otherwise(time)


def read_times(c: Column, dtype: T.DataType, formats: Formats) -> Column:
    """A text column's times by its own formats; values of other shapes as ``to_time`` reads them."""
    if not S.is_text(dtype) or not formats:
        return S.to_time(c, dtype)
    shape, text = _shape(c), F.trim(c)
    read = None
    for name, patterns in formats.items():
        times = F.coalesce(*[_read(text, p) for p in patterns.split("|")])
        read = F.when(shape == name, times) if read is None else read.when(shape == name, times)
    known = F.when(F.year(read).between(S.FIRST_YEAR, S.LAST_YEAR), read)
    return F.when(shape.isin(*formats), known).otherwise(S.to_time(c, dtype))
