"""Sharding: the permutation against plain integers, and whole tables dealt back."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabulyst.llm import queries, sharding
from tabulyst.llm.common import numbers, ship
from tabulyst.llm.sharding import Permutation

SCHEMA = "doc_id long, text string, `size` string, slot string, `row` long, number string"


def plain(x, rows, seed):
    """One number through the network in Python's integers."""
    mask64 = (1 << 64) - 1
    half = max(1, (max(rows - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    keys = [int(k) for k in numbers(sharding.ROUNDS, 1000 + seed)]

    def mix(v):
        v = ((v ^ (v >> 30)) * 0xBF58476D1CE4E5B9) & mask64
        v = ((v ^ (v >> 27)) * 0x94D049BB133111EB) & mask64
        return v ^ (v >> 31)

    while True:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix((right + k) & mask64) & mask)
        x = (left << half) | right
        if x < rows:
            return x


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 23, 24, 25, 100, 4097])
def test_permutation(rows):
    p = Permutation(rows, 7)
    number = np.arange(rows)
    place = p.forward(number)
    assert sorted(place.tolist()) == list(range(rows))
    assert place.tolist() == [plain(i, rows, 7) for i in range(rows)]
    assert p.backward(place).tolist() == number.tolist()
    shard, slot = p.places(number)
    assert p.numbers(shard, slot).tolist() == number.tolist()


def test_seeds_differ():
    number = np.arange(1000)
    a, b = Permutation(1000, 1).forward(number), Permutation(1000, 2).forward(number)
    assert (a == b).mean() < 0.02
    # neighbours part: about one in 24 stays together
    assert (np.diff(a % 24) == 0).mean() < 0.1


def check_law(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(slots[k]) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.registered()["op13_feistel_shards"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    check_law(rows)
    want = sorted((d["doc_id"], (d["text"] or "").encode()) for d in docs)
    assert sorted(r["number"] for r in rows) == list(range(len(docs)))
    for r, (i, text) in zip(sorted(rows, key=lambda r: r["number"]), want, strict=True):
        assert (r["doc_id"], r["size"], r["text_crc32"]) == (i, len(text) + 8, zlib.crc32(text))
        assert (r["law"], r["grown_shard"]) == ("rows", None)
        assert plain(r["number"], len(docs), 0) == r["slot"] * 24 + r["shard"]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    rows = [(i, t, "s", "t", 1, None) for i, t in enumerate([None, "", " ", "é🙂", "x" * 100000, "same", "same"])]
    rows += [(None, "no id", None, None, None, None), (None, None, None, None, None, None), (5, "other text", None, None, 2, "n")]
    return spark.createDataFrame(rows + [(77, "copy", "c", "d", 3, "e")] * 200, SCHEMA)


def test_odd_rows(odd, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 16)
    first = sharding.shard_places(odd.repartition(3)).collect()
    again = sharding.shard_places(odd.repartition(7)).collect()
    assert sorted(map(tuple, first), key=str) == sorted(map(tuple, again), key=str)
    check_law(first)
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in odd.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in first) == want


def test_whole_rows_and_files(spark, odd, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 16)
    dealt = sharding.sharded(odd).collect()
    check_law(dealt)
    assert Counter(tuple(r["row"]) for r in dealt) == Counter(map(tuple, odd.collect()))
    sharding.write_shards(odd, str(tmp_path / "shards"), parts=2)
    for k in range(24):
        back = spark.read.parquet(str(tmp_path / "shards" / f"shard={k}")).collect()
        want = {r["slot"]: (r["number"], r["row"]) for r in dealt if r["shard"] == k}
        assert {r["slot"]: (r["number"], r["row"]) for r in back} == want


def test_empty(spark, odd):
    none = odd.filter("false")
    assert sharding.places_by_law(none).collect() == []
    assert sharding.sharded(none).collect() == []
