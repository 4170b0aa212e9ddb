"""Row positions in file order, and the first rows by them.

Files count in order of their names. Each split of a file is read by one task from front to
back, so a row's position is that of its split plus its place there. The splits' positions are prefix
sums of their row counts; no row is sorted or moved. Only as many files are
read as hold the rows asked for, to within a factor of STEP.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Files that are counted first, and how many times more in each further round.
FILES, STEP = 4, 4
_SPLIT = ["__file", "__block"]

Reread = Callable[[list[str]], DataFrame]


def _placed(df: DataFrame) -> DataFrame:
    """With each row's file, split and number in its task."""
    meta = F.col("_metadata")
    return df.select("*", meta["file_path"].alias("__file"), meta["file_block_start"].alias("__block"), F.monotonically_increasing_id().alias("__id"))


def from_files(df: DataFrame) -> bool:
    """Whether the rows come straight from files, in their order."""
    try:
        df.select("_metadata.file_block_start")
    except AnalysisException:
        return False
    return True


def _splits(placed: DataFrame, most: int | None) -> list[tuple]:
    """(file, block, rows before it, first number) of the splits in order, up to the one that
    holds row ``most``."""
    counted = placed.groupBy(*_SPLIT).agg(F.count("*").alias("rows"), F.min("__id").alias("first")).orderBy(*_SPLIT)
    out, before = [], 0
    for r in counted.toLocalIterator():
        out.append((r["__file"], r["__block"], before, r["first"]))
        before += r["rows"]
        if most is not None and before >= most:
            break
    return [*out, (None, None, before, None)]


def row_positions(df: DataFrame, position: str = "position", most: int | None = None, reread: Reread | None = None) -> DataFrame:
    """``df`` with each row's position from 0, or its first ``most`` rows with theirs.

    ``df`` is a table read from files, with rows left out or columns changed at most: positions
    are among the rows that are left. The driver sees one row for each split. ``reread`` gives the
    same table of some files alone; without it, all files are counted.
    """
    names, upto = sorted(df.inputFiles()), FILES
    while True:
        whole = most is None or reread is None or upto >= len(names)
        placed = _placed(df if whole else reread([unquote(name) for name in names[:upto]]))
        splits = _splits(placed, most)
        if whole or splits[-1][2] >= most:
            break
        upto *= STEP
    known = df.sparkSession.createDataFrame(splits[:-1], "__file string, __block long, __before long, __first long")
    found = placed.join(F.broadcast(known), _SPLIT).withColumn(position, F.col("__before") + F.col("__id") - F.col("__first"))
    if most is not None:
        found = found.filter(F.col(position) < most)
    return found.select(*[F.col(f"`{c}`") for c in df.columns], position)


def first_rows(df: DataFrame, n: int, reread: Reread | None = None) -> DataFrame:
    """The first ``n`` rows in file order; any ``n`` rows if ``df`` isn't read from files and
    has no order."""
    if not from_files(df):
        return df.limit(n)
    return row_positions(df, "__position", max(n, 0), reread).drop("__position")
