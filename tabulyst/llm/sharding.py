"""Shards by a permutation of global row numbers.

1. Every row gets a global number from 0: its rank by doc_id (null first), then by the size,
   check sum and digest of its content. Equal rows are counted before anything is shuffled
   and travel as one entry with a count, cut into pieces of BLOCK; only these entries are
   ordered, in ranges, and prefix sums over the ranges make the numbers.
2. A keyed Feistel network permutes the numbers: a network over 4 ** h >= N values is a
   bijection, and a value of N or more is sent through it again until it falls below N.
3. The shard of a permuted number is its remainder by the number of shards, the slot its
   quotient: shards differ by one row at most and slots have no gaps.

Numbers depend on the rows alone, not on files, splits or the cluster; the permutation
on N and the seed. Both ways are computed without any table: ``Permutation.places`` gives
shard and slot of a number, ``Permutation.numbers`` the number in a shard's slot.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulyst.llm.common import mixed, numbers
from tabulyst.session import stage

SHARDS = 24
#: Rounds of the network; four make a Feistel network hard to tell from a random permutation.
ROUNDS = 6
#: Copies of one row that travel as one entry.
BLOCK = 1 << 16
#: Bytes that a row takes besides its text.
OVERHEAD = 8

_KEY = ["doc_id", "size", "text_crc32", "h1", "h2"]


@dataclass(frozen=True)
class Permutation:
    """A bijection of 0 to ``rows`` - 1, fixed by ``rows`` and ``seed``."""

    rows: int
    seed: int = 0

    @property
    def _half(self) -> int:
        return max(1, (max(self.rows - 1, 1).bit_length() + 1) // 2)

    def _network(self, x: np.ndarray, back: bool) -> np.ndarray:
        half, mask = np.uint64(self._half), np.uint64((1 << self._half) - 1)
        left, right = x >> half, x & mask
        keys = numbers(ROUNDS, 1000 + self.seed)
        with np.errstate(over="ignore"):
            if back:
                for k in keys[::-1]:
                    left, right = right ^ (mixed(left + k) & mask), left
            else:
                for k in keys:
                    left, right = right, left ^ (mixed(right + k) & mask)
        return (left << half) | right

    def _walked(self, x: np.ndarray, back: bool) -> np.ndarray:
        """Through the network until below ``rows``: under four steps on average."""
        x = self._network(np.asarray(x, np.uint64), back)
        while len(out := np.flatnonzero(x >= np.uint64(self.rows))):
            x[out] = self._network(x[out], back)
        return x.astype(np.int64)

    def forward(self, number: np.ndarray) -> np.ndarray:
        return self._walked(number, False)

    def backward(self, place: np.ndarray) -> np.ndarray:
        return self._walked(place, True)

    def places(self, number: np.ndarray, shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot of each global number."""
        place = self.forward(number)
        return place % shards, place // shards

    def numbers(self, shard: np.ndarray, slot: np.ndarray, shards: int = SHARDS) -> np.ndarray:
        """The global number in each slot of a shard."""
        return self.backward(np.asarray(slot) * shards + np.asarray(shard))


def _digest(docs: DataFrame) -> list[Column]:
    """128 bits of all columns; a null is told apart from any value and place."""
    values = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(seed), *values).alias(name) for seed, name in ((1, "h1"), (2, "h2"))]


def _keyed(docs: DataFrame) -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), *_digest(docs)]


def _running(batches):
    """Adds the partition's number and what its earlier entries hold."""
    from pyspark import TaskContext

    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        many = batch.column("many").to_numpy()
        ends = before + np.cumsum(many)
        columns = [*batch.columns, pa.array(np.full(len(many), part, np.int64)), pa.array(ends - many)]
        before = int(ends[-1]) if len(ends) else before
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "before"])


def _numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, size, text_crc32, h1, h2, many, first``: entries of equal rows and their first
    number; and the number of all rows. The driver sees one sum for each partition."""
    spark = docs.sparkSession
    counted = stage(docs.select(*_keyed(docs)).groupBy(*_KEY).agg(F.count("*").alias("copies")), "counted")
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BLOCK))).alias("piece")
    pieces = counted.select("*", at).withColumn("many", F.least(F.lit(BLOCK).cast("long"), F.col("copies") - F.col("piece") * BLOCK)).drop("copies")
    order = [*_KEY, "piece"]
    ordered = pieces.repartitionByRange(*order).sortWithinPartitions(*order).select(*_KEY, "many")
    schema = ", ".join(f"{c} long" for c in (*_KEY, "many", "part", "before"))
    running = stage(ordered.mapInArrow(_running, schema), "running")
    sums = sorted((r["part"], r["n"]) for r in running.groupBy("part").agg(F.sum("many").alias("n")).collect())
    starts, total = [], 0
    for part, n in sums:
        starts.append((part, total))
        total += n
    offsets = F.broadcast(spark.createDataFrame(starts, "part long, start long"))
    return running.join(offsets, "part").select(*_KEY, "many", (F.col("start") + F.col("before")).alias("first")), total


def _opened(entries: DataFrame) -> DataFrame:
    """One row for each copy: the entry's columns and ``number``. Entries of one group lie
    side by side, so those of several copies are dealt apart first."""
    kept = [c for c in entries.columns if c not in ("many", "first")]
    each = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("many") - 1)).alias("number")
    copies = entries.filter("many > 1").repartition("first").select(*kept, each)
    return entries.filter("many = 1").select(*kept, F.col("first").alias("number")).unionByName(copies)


def _placed(entries: DataFrame, rows: int, shards: int, seed: int) -> DataFrame:
    """One row for each copy: the entry's columns, ``number, shard, slot``."""
    single = _opened(entries)

    def place(batches):
        permutation = Permutation(rows, seed)
        for batch in batches:
            shard, slot = permutation.places(batch.column("number").to_numpy(), shards)
            yield batch.append_column("shard", pa.array(shard.astype(np.int32))).append_column("slot", pa.array(slot))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in single.schema)
    return single.mapInArrow(place, f"{schema}, shard int, slot long")


def shard_places(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """``doc_id, size, text_crc32, number, shard, slot`` of each row of ``docs``.

    Null texts count as empty. Rows equal in all columns can't be told apart, so it doesn't matter which
    of them gets which place; repeated and null doc_ids are rows like others. An empty table
    gives no rows. Columns besides doc_id and text count for the order of rows that are equal
    in these. The text never leaves the scan: only digests are shuffled.
    """
    entries, rows = _numbered(docs)
    return _placed(entries, rows, shards, seed).select("doc_id", "size", "text_crc32", "number", "shard", "slot")


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """``number, shard, slot`` and the whole row as struct ``row``, for each row of ``docs``.

    A row travels once for its copies: the join is with entries of up to BLOCK copies, which
    are dealt apart before they are opened.
    """
    entries, rows = _numbered(docs)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    content = docs.select(*_digest(docs), whole).dropDuplicates(["h1", "h2"])
    joined = entries.select("h1", "h2", "many", "first").join(content, ["h1", "h2"]).select("many", "first", "row")
    return _placed(joined, rows, shards, seed).select("number", "shard", "slot", "row")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, seed: int = 0, parts: int = 8) -> None:
    """Writes ``number, slot, row`` to ``folder``/shard=K in slot order, each shard as some
    ``parts`` files of consecutive slots, so that no task holds a shard."""
    placed = sharded(docs, shards, seed).repartitionByRange(shards * parts, "shard", "slot")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)


def places_by_law(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and ``number``: shards whose
    row counts differ by one at most."""
    return shard_places(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                     F.lit(None).cast("int").alias("grown_shard"), "number")
