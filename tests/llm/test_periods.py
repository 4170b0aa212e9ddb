"""Runs of words against a search by every period."""

import hashlib
import random
import re
import zlib

import pytest

from tabulyst.llm import periods, queries
from tabulyst.llm.common import ship


def brute(words, least=periods.LEAST):
    """All runs, one period after the other; (start, length, period) by start and period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((b, e - b, q) for (b, e), q in found.items()), key=lambda r: (r[0], r[2]))


def made(rng, n):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:
        words = ["a"]
        while len(words) < n:
            words = words * rng.randint(1, 5) + [rng.choice("abc") for _ in range(rng.randint(0, 3))]
        return words[:n]
    if kind == 2:
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    p = rng.randint(1, max(1, n // 3))
    piece = [rng.choice("abcdefghij"[: rng.randint(1, 10)]) for _ in range(p)]
    words = (piece * (n // p + 1))[:n]
    for _ in range(rng.randint(0, 3)):
        if words:
            words[rng.randrange(n)] = rng.choice("abxyz")
    return words


@pytest.mark.parametrize("seed", range(8))
def test_runs(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [[w.encode() for w in made(rng, rng.choice([0, 1, 23, 24, 30, 80, 200, 500, 900]))] for _ in range(rng.randint(1, 6))]
        assert periods._batch_runs(texts) == [brute(t) for t in texts]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text, edit=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if edit and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    return {
        "doc_id": doc_id, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        "collapsed_sha256": digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    }


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r.asDict() for r in queries.registered()["op11_synchronised_runs"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        if len(d["text"] or "") < 20000:
            assert rows[d["doc_id"]] == expected(d["doc_id"], d["text"])
    assert sum(r["n_runs"] > 0 for r in rows.values()) > 3


ODD = [None, "", " \t\n", "one", "a " * 23, "a " * 24, "a " * 5000, "é 日本 " * 40, "x y z " * 30, "la\x0bla\x0cla\rla " * 9,
       " ".join("ab" * 40 + "abc" * 30), "same words here " * 9, "same words here " * 9]


def test_odd_rows(spark):
    ship(spark)
    schema = "doc_id long, text string, `runs` string, start long, collapsed string"
    rows = [(i, t, "r", 1, "c") for i, t in enumerate(ODD)] + [(5, ODD[5], "r", 1, "c"), (None, "b " * 30, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    got = [r.asDict() for r in periods.run_digests(periods.periodic_runs(docs.repartition(3))).collect()]
    want = [expected(r[0], r[1], edit=False) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periods.run_digests(periods.periodic_runs(docs.filter("false"), periods.repeat_tail)).collect() == []
    # damage depends on the id; a null id changes nothing
    edited = {r["doc_id"]: r.asDict() for r in periods.run_digests(periods.periodic_runs(docs.filter("doc_id is null"), periods.repeat_tail)).collect()}
    assert edited[None] == expected(None, "b " * 30)


def test_long_text(spark):
    ship(spark)
    rng = random.Random(5)
    words = [str(rng.randrange(50000)) for _ in range(400000)]
    words[100000:130000] = words[100000:101000] * 30
    text = " ".join(words)
    found = periods.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    (run,) = found["runs"]
    assert (run["period"], run["start"] <= 100000, run["start"] + run["length"] >= 130000) == (1000, True, True)
    assert len(found["collapsed"].split()) == 400000 - run["length"] + 1000
