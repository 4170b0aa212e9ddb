"""What both vector searches share: the vectors that take part, as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def valid(table: DataFrame, zero: bool) -> DataFrame:
    """``vec_id, v`` (doubles) of rows with an id whose vectors are not null and hold no null,
    NaN or infinity; all-zero vectors only if ``zero``. An empty vector is one zero."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(~bad)
    rows = rows.withColumn("v", F.when(F.size("v") > 0, F.col("v")).otherwise(F.array(F.lit(0.0))))
    return rows if zero else rows.filter(F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Lists of doubles as rows; short ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out
