"""Near-duplicate documents by banded MinHash, odd sketches and exact confirmation.

1. One pass over the texts keeps, for each document, the size and a digest of its shingle
   set, MinHash band keys and two odd sketches, of its MinHash samples and of the whole set.
   Equal sets fall into one class at once, so groups of copies cost one row each from here on.
2. In each bucket of a band key the classes are paired with up to LEADERS of its smallest
   ids, not with each other. The XOR population counts of their odd sketches discard pairs
   that are less similar; the rest is confirmed on the full sets. The samples' sketch tells
   long texts apart. The whole set's one is sharp for short and middling texts: its count
   never exceeds the number of shingles that only one side has.
3. After joining the confirmed links into components, buckets which still hold several
   components pair the members outside their largest component with all others: sizes and
   sketches are compared inside the join, and what passes is confirmed as well. Only
   pairs that are already known to be connected are never looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulyst.llm import shingles
from tabulyst.llm.common import utf8_of
from tabulyst.llm.links import components
from tabulyst.session import stage

#: 32 bands of 4: a pair at similarity 0.8 shares a bucket but for 5 in 10^8 cases.
SAMPLES, ROWS_EACH, BITS = 128, 4, 512
LEADERS = 4
#: Standard deviations of the estimate below the threshold that a pair may lie.
MARGIN = 4.5

_WORDS = BITS // 64
_SAMPLED, _WHOLE = [f"s{i}" for i in range(_WORDS)], [f"w{i}" for i in range(_WORDS)]
_SKETCH = _SAMPLED + _WHOLE
SIGNATURES = "doc_id long, n_shingles long, d0 long, d1 long, sketch array<long>, bands array<long>"


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """One row per document; without words the count is 0 and the lists are empty."""

    def sign(batches):
        for batch in batches:
            data, offsets = utf8_of(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b, hashes, row in shingles.words(data, offsets):
                value, counts = shingles.shingle_sets(hashes, row, b - a, size)
                some = (counts > 0).astype(np.int64)
                samples = shingles.min_hashes(value, counts, SAMPLES)
                sketch = np.hstack([shingles.odd_sketches(samples, BITS), shingles.odd_sets(value, counts, BITS)])
                digest = np.zeros((b - a, 2), np.int64)
                digest[counts > 0] = shingles.digests(value, counts)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(counts, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                     _lists(sketch.ravel(), some * len(_SKETCH)),
                     _lists(shingles.bands(samples, ROWS_EACH).ravel(), some * (SAMPLES // ROWS_EACH))],
                    ["doc_id", "n_shingles", "d0", "d1", "sketch", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sign, SIGNATURES)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``id, shingles`` of each document: its class and the whole set."""

    def gather(batches):
        for batch in batches:
            data, offsets = utf8_of(batch.column("text"))
            for a, b, hashes, row in shingles.words(data, offsets):
                value, counts = shingles.shingle_sets(hashes, row, b - a, size)
                owner = shingles.digests(value, counts)[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(owner), _lists(value.view(np.int64), counts[counts > 0])], ["id", "shingles"])

    return docs.select("text").mapInArrow(gather, "id long, shingles array<long>")


def largest_distance(threshold: float) -> int:
    """The XOR population count that pairs at ``threshold`` exceed hardly ever."""
    mean = SAMPLES * (1 - threshold)
    apart = mean + MARGIN * math.sqrt(mean * threshold)  # samples that differ
    expected = BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * apart))
    return math.ceil(expected + MARGIN * math.sqrt(max(0.0, 2 * apart - expected) / 2))


def _apart(names: list[str]) -> Column:
    return sum((F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in names), F.lit(0))


def _most_flips(percent: int) -> Column:
    """What the whole sets' XOR population count can be at most: the shingles of one side
    alone, which the sizes bound; where those fill the bitmap, MARGIN deviations above its
    mean (bits that are flipped twice are lost)."""
    alone = (F.col("a.n") + F.col("b.n")) * ((100 - percent) / (100 + percent))
    mean = BITS / 2 * (1 - F.exp(alone * (-2 / BITS))) + 1
    spread = F.least(F.sqrt(F.greatest(alone - mean, F.lit(0.0)) * 2), F.lit(math.sqrt(BITS) / 2))
    return F.least(alone + 1e-6, mean + MARGIN * spread)


def _plausible(percent: int) -> Column:
    """Sizes and sketches allow the similarity. For sides ``a`` and ``b``."""
    small, large = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    sampled = _apart(_SAMPLED) <= largest_distance(percent / 100)
    return (100 * small >= percent * large) & sampled & (_apart(_WHOLE) <= _most_flips(percent))


def _sketched(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    one = pairs.join(sketches.select(F.col("id").alias("u"), F.struct("n", *_SKETCH).alias("a")), "u")
    return one.join(sketches.select(F.col("id").alias("v"), F.struct("n", *_SKETCH).alias("b")), "v")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The full sets of the classes in ``wanted``, from a text of each."""
    which = classes.select("id", "doc_id").join(wanted, "id").select("doc_id").distinct()
    return stage(full_sets(docs.join(which, "doc_id", "left_semi"), size).dropDuplicates(["id"]), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` whose full sets are similar enough. Sets are joined one side at a
    time, so a leader's set is sent once and its pairs can be split over tasks."""
    half = pairs.join(sets.select(F.col("id").alias("v"), F.col("shingles").alias("y")), "v")
    both = half.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("x")), "u")
    common = F.size(F.array_intersect("x", "y")).cast("long")
    union = F.size("x") + F.size("y") - common
    return both.filter(100 * common >= percent * union).select("u", "v")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their sets of
    distinct ``size``-word shingles; ``component_id`` is the smallest doc_id that links
    reach, and ``kept`` marks that document. Null, empty and blank texts have no
    shingles and are linked with nothing. Rows with a null doc_id are linked with nothing,
    have a null component and are kept. Rows that repeat a doc_id count as copies or near
    copies like any others, and all that carry the component's id are kept.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = stage(signatures(docs, size), "signatures")
    real = signed.filter("n_shingles > 0 and doc_id is not null")
    # a class of equal sets goes by the first word of its digest
    first = F.min_by(F.struct("sketch", "bands"), "doc_id")
    classes = stage(
        real.groupBy("n_shingles", "d0", "d1").agg(F.min("doc_id").alias("doc_id"), first.alias("f"))
        .select("n_shingles", "d0", "d1", "doc_id", F.col("d0").alias("id"), "f.bands", *(F.col("f.sketch")[i].alias(s) for i, s in enumerate(_SKETCH))), "classes")
    sketches = classes.select("id", F.col("n_shingles").alias("n"), *_SKETCH)
    member = classes.select(F.explode("bands").alias("key"), "id")
    shared = stage(member.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y")).filter("x <> y").select("key"), "shared")
    buckets = stage(member.join(shared, "key"), "buckets")

    leads = [F.min(F.when(F.pmod(F.xxhash64("id"), F.lit(LEADERS)) == j, F.col("id"))).alias(f"l{j}") for j in range(LEADERS)]
    leaders = stage(buckets.groupBy("key").agg(*leads), "leaders")
    lead = F.explode(F.array(*(f"l{j}" for j in range(LEADERS)))).alias("lead")
    star = buckets.join(leaders, "key").select("id", lead).filter("lead <> id")
    star = star.select(F.least("id", "lead").alias("u"), F.greatest("id", "lead").alias("v")).distinct()
    pairs = stage(_sketched(star, sketches).filter(_plausible(percent)).select("u", "v"), "pairs")

    paired = pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).distinct()
    sets = _sets(docs, classes, paired, size)
    links = stage(_confirmed(pairs, sets, percent), "links")
    known = stage(components(links), "components")

    # buckets in which several components are left
    at = stage(buckets.join(known, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component")), "members")
    several = at.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
    left = stage(at.join(stage(several, "several"), "key").join(sketches, "id"), "left")
    held = left.groupBy("key", "component").agg(F.count("*").alias("c"))
    main = held.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("main"))
    outside = left.join(stage(main, "main"), "key").filter("component <> main")
    a, b = stage(outside, "outside").alias("a"), left.alias("b")
    # a pair of two that are both outside is taken once
    once = (F.col("b.component") == F.col("a.main")) | (F.col("a.id") < F.col("b.id"))
    cross = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component")) & once & _plausible(percent))
    cross = cross.select(F.least("a.id", "b.id").alias("u"), F.greatest("a.id", "b.id").alias("v")).distinct()
    rest = stage(cross.join(pairs, ["u", "v"], "left_anti"), "pairs")
    if not rest.isEmpty():
        paired = rest.select(F.col("u").alias("id")).unionByName(rest.select(F.col("v").alias("id"))).distinct()
        links = links.unionByName(stage(_confirmed(rest, _sets(docs, classes, paired, size), percent), "links"))
        known = stage(components(links), "components")

    named = classes.select("n_shingles", "d0", "d1", "id", "doc_id").join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = stage(named.join(stage(lowest, "lowest"), "component").select("n_shingles", "d0", "d1", "component_id"), "named")
    out = signed.select("doc_id", "n_shingles", "d0", "d1").join(named, ["n_shingles", "d0", "d1"], "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))
