"""The triangular factor of a tall design, without its Gram matrix.

Each task factors its rows batch by batch; the factors of the tasks are stacked and factored again,
first in a few tasks, then on the driver, which sees matrices
of the design's columns alone. Squaring the design would square its condition number; this
keeps it.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _reduced(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def triangular_factor(df: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """R of the matrix of a leading 1 and ``columns`` (without gaps), with one row for each
    column; its rows' signs are arbitrary. An empty table gives zeros."""
    width = len(columns) + 1

    def factor(batches):
        r = np.zeros((0, width))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                values = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in part.columns]
                r = np.linalg.qr(np.vstack([r, np.stack([np.ones(part.num_rows), *values], axis=1)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def merge(batches):
        r = np.zeros((0, width))
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                r = np.linalg.qr(np.vstack([r, np.frombuffer(blob).reshape(-1, width)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    rows = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = rows.mapInArrow(factor, "r binary")
    few = max(1, isqrt(df.sparkSession.sparkContext.defaultParallelism))
    merged = parts.repartition(few).mapInArrow(merge, "r binary").collect()
    r = np.zeros((width, width))
    for row in merged:
        r = _reduced(np.vstack([r, np.frombuffer(row["r"]).reshape(-1, width)]))
    return r
