"""Whole-row copies, found by digest before any row travels.

One pass counts 64-bit digests of the rows, so that eight bytes a row are shuffled. Digests that came
twice go into a Bloom filter whose size is bounded: a table of blocks, built by tasks and broadcast, so
that no plan holds it. A row that the filter rules out has no copy and stays where it was read; the
others, the rows with copies and a few more, are shuffled and compared as whole rows. A clash of digests
or a false hit only adds a row to those that are compared, so results are exact.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions.scalars import col
from tabulyst.session import stage

#: How often a row comes.
COPIES = "__copies"
MAYBE, _DIGEST, _BLOCK, _WORDS = "__maybe", "__digest", "__block", "__words"
#: Bits of the filter at most (16 MB), bits wanted for each digest and those it pays with, and hashes of
#: a digest: with the least, a sixth of the rows without copies travel too.
FILTER_BITS, BITS_EACH, LEAST_EACH, HASHES = 1 << 27, 16, 4, 4
#: Bits of a block of the filter, which holds all bits of a digest, and of their places.
BLOCK, PLACE_BITS = 4096, 12
#: Rows that take fewer bytes than this are shuffled as they are.
NARROW = 64


def _width(kind: T.DataType) -> int:
    """About how many bytes a value takes; those without a fixed size count as wide."""
    fixed = {T.ByteType: 1, T.BooleanType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}
    return next((n for k, n in fixed.items() if isinstance(kind, k)), NARROW if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)) else 8)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _block(digest: Column, bits: int) -> Column:
    """The block of a digest in a filter of ``bits`` bits, a power of two."""
    return digest.bitwiseAND(F.lit(bits // BLOCK - 1).cast("long"))


def _places(digest: Column) -> list[Column]:
    """Where a digest's bits are in its block: the digest's high bits, which choose no block."""
    return [F.shiftrightunsigned(digest, 63 - PLACE_BITS * k).bitwiseAND(F.lit(BLOCK - 1)).cast("int") for k in range(1, HASHES + 1)]


def _filter(twice: DataFrame, bits: int) -> DataFrame:
    """The filter as blocks of 64-bit words, those without a bit left out; each digest travels once."""
    dealt = twice.select(_block(F.col("digest"), bits).alias(_BLOCK), "digest").repartition(_BLOCK)
    at = dealt.select(_BLOCK, F.explode(F.array(*_places(F.col("digest")))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)))
    words = at.groupBy(_BLOCK, F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    # at most 64 words of a block
    own = words.groupBy(_BLOCK).agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("own"))
    word = F.transform(F.sequence(F.lit(0), F.lit(BLOCK // 64 - 1)), lambda i: F.coalesce(F.element_at("own", i), F.lit(0).cast("long")))
    return own.select(_BLOCK, word.alias(_WORDS))


def _has(words: Column, at: Column) -> Column:
    return F.getbit(F.get(words, F.shiftright(at, 6)), at.bitwiseAND(F.lit(63))) == 1


class Repeated:
    """Which rows of ``df`` may have copies. ``df`` must give the same rows each time."""

    def __init__(self, df: DataFrame, staged: bool = False):
        # a generated column is worked out once: a projected one would be put into each use of it
        self.df = df.select("*", F.explode(F.array(F.xxhash64(*[col(c) for c in df.columns]))).alias(_DIGEST))
        if staged:
            self.df = stage(self.df, "digested")
        seen = Observation()
        counted = self.df.groupBy(F.col(_DIGEST).alias("digest")).agg(F.count("*").alias("copies"))
        counted = counted.observe(seen, F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"), F.count("*").alias("digests"))
        self._twice = stage(counted.filter("copies > 1").select("digest"), "twice")
        self.rows, self.digests = seen.get["rows"], seen.get["digests"]
        self.twice = self._twice.count()
        self.bits = max(BLOCK, min(FILTER_BITS, 1 << max(self.twice * BITS_EACH - 1, 0).bit_length()))
        self._blocks = None

    @staticmethod
    def pays(df: DataFrame) -> bool:
        """Whether rows are wide enough for digests to be worth a pass, and have digests."""
        return sum(_width(f.dataType) for f in df.schema) >= NARROW and all(_hashable(f.dataType) for f in df.schema)

    @property
    def fits(self) -> bool:
        return self.twice * LEAST_EACH <= FILTER_BITS

    def marked(self) -> DataFrame:
        """The rows with ``MAYBE``: whether the filter has their digest, as for all with copies."""
        if not self.twice:
            return self.df.withColumn(MAYBE, F.lit(False)).drop(_DIGEST)
        if self._blocks is None:
            self._blocks = stage(_filter(self._twice, self.bits), "filter")
        # FILTER_BITS / BLOCK blocks of 512 bytes at most
        near = self.df.join(F.broadcast(self._blocks), _block(F.col(_DIGEST), self.bits) == F.col(_BLOCK), "left")
        maybe = F.coalesce(reduce(and_, [_has(F.col(_WORDS), at) for at in _places(F.col(_DIGEST))]), F.lit(False))
        return near.withColumn(MAYBE, maybe).drop(_DIGEST, _BLOCK, _WORDS)

    def parts(self) -> tuple[DataFrame, DataFrame]:
        """The rows without copies and the others."""
        rows = self.marked()
        return rows.filter(~F.col(MAYBE)).drop(MAYBE), rows.filter(MAYBE).drop(MAYBE)


def _settled(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*[col(c) for c in rows.columns]).agg(F.count("*").alias(COPIES))


def counted_rows(df: DataFrame, staged: bool = False) -> DataFrame:
    """The distinct rows of ``df``, each with its number of copies in ``COPIES``. With ``staged``
    the table is written once, with its digests, and read from there."""
    found = Repeated(df, staged) if Repeated.pays(df) else None
    if found is None or not found.fits:
        counted = _settled(found.df.drop(_DIGEST) if found and staged else df)
        return stage(counted, "unique") if staged else counted
    single, rest = found.parts()
    rest = stage(_settled(rest), "settled") if staged else _settled(rest)
    return single.withColumn(COPIES, F.lit(1).cast("long")).unionByName(rest)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row of ``df`` once."""
    return counted_rows(df).drop(COPIES)


def row_counts(df: DataFrame) -> DataFrame:
    """(n_rows, n_distinct) of ``df``."""
    found = Repeated(df) if Repeated.pays(df) else None
    if found is None or not found.fits:
        return _settled(df).agg(F.coalesce(F.sum(COPIES), F.lit(0)).alias("n_rows"), F.count("*").alias("n_distinct"))
    # rows that the filter lets through without need are among the distinct ones either way
    rest = _settled(found.parts()[1]).agg(F.coalesce(F.sum(COPIES), F.lit(0)).alias("some"), F.count("*").alias("n"))
    return rest.select(F.lit(found.rows).cast("long").alias("n_rows"), (F.lit(found.rows) - F.col("some") + F.col("n")).alias("n_distinct"))
