"""Each operator against a brute-force twin, on odd rows and on whole small tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from tabulyst.llm import bitslices, bpe, counts, language, nearest, neardup, packing, privacy, quality, shingles, warc
from tabulyst.llm.common import ship, table, tokenizer_file

WORDS = tokenizer_file("word_bpe_49k.json")
PIECES = tokenizer_file("piece_bpe_32k.model")
RANKS = tokenizer_file("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, email string, `key` string, ids string"

ODD = [
    None, "", " ", "\n", "a", "A.", "12 34", "The cat's 'S naïve CAFÉ ½ 日本 é́ 🙂", "x  y", " lead", "trail ", "\nline", "a\n\nb\n",
    "<|endoftext|> <s>", "tab\tcr\r\nnul\x01", "word " * 9000, "z" * 30000, "same text here now", "same text here now", "Same  TEXT here\nnow",
]


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    rows = [(i, t, "en" if i % 2 else None, None, 1, "e", "k", "i") for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows + rows[7:8] + [(None, "no id", None, None, None, None, None, None)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf):
    ship(spark)
    return table(spark, sf, "documents")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def both(odd, docs):
    return [(r["doc_id"], r["text"] or "") for d in (odd, docs) for r in d.select("doc_id", "text").collect()]


def results(function, odd, docs):
    return [r.asDict() for d in (odd, docs) for r in function(d).collect()]


def test_language(odd, docs, none):
    found = language.identify(docs).collect()
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    tested = [r["lang_pred"] == langs[r["doc_id"]] for r in found if r["held_out"]]
    assert sum(tested) / len(tested) > 0.9
    known = language.prototypes(docs)
    text = {i: t for i, t in enumerate(ODD)}
    for r in language.classified(odd, known).collect():
        t = text.get(r["doc_id"], "no id") or ""
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in t))
    assert language.identify(none).count() == 0
    assert {r["lang_pred"] for r in language.classified(odd, {}).collect()} == {"und"}
    assert language.accepted(docs, known).columns == docs.columns


def test_language_vectors_are_bound_trigrams():
    one = language.letter_vectors(np.array([0, ord("a"), ord("b")]))
    want = np.roll(one[0], 2) * np.roll(one[1], 1) * one[2] + np.roll(one[1], 2) * np.roll(one[2], 1) * one[0]
    got, some = language.document_vectors(["", "1", "Ab!", "ab ab"])
    assert some.tolist() == [False, False, True, True]
    assert np.allclose(got[2], want / np.linalg.norm(want), atol=1e-6)
    assert np.allclose(got[2], got[3], atol=1e-6)


def test_quality(spark, odd, docs, none, sf):
    labels = table(spark, sf, "labels")
    got = quality.rate_by_labels(docs, labels).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 1 >= r["p_not_toxic"] >= r["p_good"] >= 0 and abs(r["expected_grade"] - r["p_not_toxic"] - r["p_good"]) < 1e-9
        assert r["selected"] == (r["p_good"] >= quality.SELECT)
    model = quality.train(docs, quality.grades(labels))
    assert quality.rate(odd, model).count() == odd.count()
    assert quality.train(docs, quality.grades(labels.limit(0))) is None
    assert {r["selected"] for r in quality.rate(odd, None).collect()} == {True}
    assert quality.rate(none, model).count() == 0
    assert quality.selected(docs, model).columns == docs.columns
    rated = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in quality.grades(rated).collect()} == {(1, 1), (2, 0)}


def test_quality_learns_the_order():
    rng = random.Random(4)
    plain = [f"w{rng.randrange(60):02d}x".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(60)]
    texts, grade = [], []
    for i in range(900):
        some = [rng.choice(plain) for _ in range(30)]
        g = i % 3
        texts.append(" ".join(some + ["vile"] * (g == 0)) if g != 1 else " ".join(w + "###" for w in some))
        grade.append(g)
    import pyarrow as pa

    row, bucket, value = quality.features(pa.array(texts))
    grade = np.array(grade)
    train = row < 600
    model = quality.fit(row[train], bucket[train], value[train], grade[:600])
    assert (np.diff(model.biases) < 0).all()
    good = quality._tails(pa.array(texts[600:]), model)[:, -1] >= 0.5
    assert ((grade[600:] == 2) == good).mean() > 0.97


def test_packing(odd, docs, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    got = [packing.pack_documents(d, WORDS).collect() for d in (odd, docs)]
    want = Counter()
    for d in (odd, docs):
        for r in d.collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
            for k in range(0, len(ids), 4096):
                part = np.array(ids[k : k + 4096], "<u4")
                want[(r["doc_id"], k // 4096, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for rows in got for r in rows) == want
    for rows in got:
        load = {}
        for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
            assert r["offset"] == load.get(r["sequence_id"], 0)
            load[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(load.values()) <= 4096
        assert len(load) <= packing.lower_bound(np.array([r["length"] for r in rows]), 4096) + 1
    assert packing.pack_documents(none, WORDS).count() == 0


def test_packing_exchanges_documents(spark):
    rng = random.Random(1)
    sizes = [rng.choice([3, 5, 30, 40, 41, 60, 99]) for _ in range(3000)]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "k long, length long")
    got = packing.pack(rows, capacity=100, per_part=100).collect()
    assert sorted(r["k"] for r in got) == list(range(3000))
    bins = len({r["sequence_id"] for r in got})
    bound = packing.lower_bound(np.array(sizes), 100)
    assert bound <= bins <= bound * 1.05
    one = packing.certificate(packing.pack(rows, 100)).first()
    assert one["total"] == sum(sizes) and one["sequences"] >= one["at_least"]


def test_lower_bound_holds():
    rng = np.random.default_rng(3)
    for _ in range(200):
        size = rng.integers(1, 31, rng.integers(1, 30))
        bins = packing.best_fit(size, 30)
        assert np.bincount(bins, weights=size).max() <= 30
        assert packing.lower_bound(size, 30) <= bins.max() + 1
    assert packing.lower_bound(np.array([16] * 9), 30) == 9


def test_bpe(odd, docs, none):
    import tiktoken

    with open(RANKS, "rb") as f:
        library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.ranks_of(f.read()), special_tokens={})
    want = Counter()
    for doc, text in both(odd, docs):
        ids = library.encode_ordinary(text)
        want[(doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    got = results(lambda d: bpe.digests(bpe.encode(d, RANKS), RANKS), odd, docs)
    assert Counter(tuple(r.values()) for r in got) == want
    assert bpe.encode(none, RANKS).count() == 0
    back = {r["doc_id"]: bytes(r["bytes"]).decode() for r in bpe.decode(bpe.encode(odd, RANKS), RANKS).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(ODD))


def test_plain_classes_split_as_the_pattern():
    import regex

    rng, quick, find = random.Random(7), re.compile(bpe.LATIN).findall, regex.compile(bpe.PATTERN).findall
    for _ in range(3000):
        t = "".join(chr(rng.randrange(256)) if rng.random() < 0.4 else rng.choice(" \n'sabÉ1.") for _ in range(rng.randint(0, 30)))
        assert quick(t) == find(t)


def components_of(rows, size):
    sets = []
    for _, text in rows:
        w = text.encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            n = len(s & sets[j])
            if n and rows[i][0] is not None and rows[j][0] is not None and 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return Counter((doc, len(sets[i]), low.get(find(i)), doc is None or doc == low[find(i)]) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(odd, docs, none, size):
    for d in (odd, docs):
        rows = [(r["doc_id"], r["text"] or "") for r in d.collect()]
        got = Counter(tuple(r) for r in neardup.near_duplicates(d, size).collect())
        assert got == components_of(rows, size)
    if size == 2:
        assert neardup.near_duplicates(none, size).count() == 0


def test_whole_set_sketches_bound_the_difference():
    rng, sets = np.random.default_rng(3), []
    base = rng.integers(0, 1 << 62, 2000, dtype=np.uint64)
    for n in (1, 2, 40, 300, 2000):
        sets += [set(base[:n].tolist()), set(base[n // 10 : n].tolist()) | {7, 8}]
    counts = np.array([*map(len, sets), 0])
    flips = shingles.odd_sets(np.array([x for s in sets for x in sorted(s)], np.uint64), counts, neardup.BITS).view(np.uint64)
    assert flips.shape == (len(sets), neardup.BITS // 64)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            apart = sum(int(x).bit_count() for x in flips[i] ^ flips[j])
            assert apart <= len(a ^ b) and (apart - len(a ^ b)) % 2 == 0


def test_near_duplicates_in_chains(spark):
    ship(spark)
    rng, rows = random.Random(8), []
    words = [f"w{i}" for i in range(120)]
    for i in range(90):  # each a few words from the last: far ends share little
        words[(i * 5) % 120] = f"c{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(rng.choice(words) for _ in range(100))) for i in range(5)]
    got = Counter(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect())
    assert got == components_of(rows, 2)


def test_token_counts(spark, odd, docs, none, tmp_path):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter((d, len(t.encode()), n := len(library.encode(t)), n > 4096) for d, t in both(odd, docs))
    got = results(lambda d: counts.token_counts(d, PIECES), odd, docs)
    assert Counter(tuple(r.values()) for r in got) == want
    assert counts.token_counts(none, PIECES).count() == 0
    cache = str(tmp_path / "cache")
    first = counts.token_counts(odd, PIECES, cache).collect()
    size = spark.read.parquet(cache).count()
    assert size == len({t or "" for t in ODD}) + 1
    assert sorted(map(str, counts.token_counts(odd, PIECES, cache).collect())) == sorted(map(str, first))
    assert spark.read.parquet(cache).count() == size  # nothing was missing
    other = counts.token_counts(odd, WORDS, cache).count()
    assert other == odd.count() and spark.read.parquet(cache).count() == 2 * size


def base_of(text):
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum((n - 9 if (n := int(c) * (1 + i % 2)) > 9 else n) for i, c in enumerate(reversed(d))) % 10 == 0

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text) if ok(m[0])]


def test_base_spans(spark, odd, docs, none):
    ship(spark)
    rng = random.Random(2)
    parts = ["a@b.c", "x.y_z@e.f", "a@b.c_d@e.f", "1.2.3.4", "999.1.1.1", "0001.02.3.255", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111", "4111111111111111",
             "+1 (229) 555-4838", "+4", "é🙂", " ", "\n", "@", "..", "-", "12", "a", "+49 30 1234567 ", "5500-0000-0000-0004", "_", "9" * 30]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))) for i in range(400)] + [(500, "9" * 20000), (501, "a" * 20000 + "@")]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    for d, of in ((made, text), (docs, {r["doc_id"]: r["text"] for r in docs.collect()}), (odd, {i: t for i, t in enumerate(ODD)})):
        for r in privacy.summary(privacy.find(d)).collect():
            spans = base_of(of.get(r["doc_id"], "no id") or "")
            assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
            assert set(spans) <= set(r["spans"].split(","))
    assert privacy.find(none).count() == 0


def test_disclosing_terms_go(spark):
    filler = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80)]
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(filler) for _ in range(8))) for i in range(150)]
    rows += [(200 + i, f"Zephyrine wrote {rng.choice(filler)} {rng.choice(filler)} to zz@mail.example") for i in range(6)]
    rows += [(300, "nothing of note here"), (301, None)]
    found = privacy.find(spark.createDataFrame(rows, "doc_id long, text string"))
    by = {r["doc_id"]: r["s"] for r in found.select("doc_id", privacy.sanitised().alias("s")).collect()}
    for i in range(6):
        assert "Zephyrine" not in by[200 + i] and "zz@" not in by[200 + i] and "[email]" in by[200 + i]
    assert by[0] == rows[0][1] and by[301] == "" and by[300] == rows[-2][1]


def test_entities_that_share_a_part_disclose(spark):
    rows = [(i, f"plain words number {i} and nothing else") for i in range(200)]
    rows += [(300 + i, f"Zephyrine wrote text {i} to person{i}@rare.example") for i in range(4)]  # a domain
    rows += [(400 + i, f"Quillonia wrote text {i} from same.person@host{i}.example") for i in range(4)]  # a name part
    rows += [(500 + i, f"Marblewick wrote text {i} by +1 (428) 555-{1000 + 37 * i}") for i in range(4)]  # a prefix
    rows += [(600 + i, f"Serverroom wrote text {i} at 10.{i}.{i}.7") for i in range(4)]  # a kind alone
    rows += [(700 + i, f"Ordinary wrote text {i}") for i in range(9)] + [(800, "Ordinary wrote to other@elsewhere.example")]
    found = privacy.find(spark.createDataFrame(rows, "doc_id long, text string"))
    by = {r["doc_id"]: r["s"] for r in found.select("doc_id", privacy.sanitised().alias("s")).collect()}
    for at, name in ((300, "Zephyrine"), (400, "Quillonia"), (500, "Marblewick"), (600, "Serverroom")):
        assert all(name not in by[at + i] and "[name]" in by[at + i] for i in range(4)), name
    assert "Ordinary" in by[800] and by[0] == rows[0][1]


def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).tolist(), 1) for i in range(400)]
    rows += [(400 + i, rows[20][1], 1) for i in range(30)]  # copies of a query
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 12, 1), (503, [None] + [1.0] * 11, 1), (504, [float("nan")] * 12, 1), (505, [float("inf")] * 12, 1), (None, [1.0] * 12, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3), rows


def test_bit_slices(spark):
    ship(spark)
    data, rows = vectors(spark)
    ok = [(i, np.floor(np.array(np.float32(v), float) * 1024).astype(int)) for i, v, _ in rows if i is not None and i < 500 or i == 502]
    got = bitslices.top_products(data, 20, 10).collect()
    want = []
    for q, x in ok:
        if q % 20 == 0:
            best = sorted((-int(x @ y), i) for i, y in ok if i != q)[:10]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert bitslices.top_products(data.limit(0)).count() == 0
    large = spark.createDataFrame([(0, [1e30, 1.0]), (1, [1e30]), (2, [-5.0, 2.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in bitslices.top_products(large, 100, 10).orderBy("rank").collect()] == [1, 2]


def test_nearest(spark):
    ship(spark)
    data, rows = vectors(spark)
    ok = [(i, np.array(np.float32(v), float)) for i, v, _ in rows if i is not None and i < 500]
    got = {}
    for r in nearest.nearest(data, 20, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hit = total = 0
    for q, x in ok:
        if q % 20 == 0:
            best = sorted((-(x @ y), i) for i, y in ok if i != q)[:20]
            hit, total = hit + len({i for _, i in best} & {i for i, _ in got[q]}), total + 20
            assert all(abs(s - x @ dict(ok)[i]) < 1e-9 for i, s in got[q])
    assert hit / total >= 0.9
    assert nearest.nearest(data.limit(0)).count() == 0


def recall(x, index, asked=64, k=20):
    """The share of true neighbours that the first rows of ``x`` meet in their buckets."""
    score = x[:asked] @ x.T
    score[np.arange(asked), np.arange(asked)] = -np.inf
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    home = index.hashes(x[near.ravel()], False).reshape(asked, k, -1)
    probed = index.hashes(x[:asked], True)
    return np.mean([np.isin(home[i], probed[i]).any(axis=1).mean() for i in range(asked)])


def test_probes_grow_with_the_table():
    x = np.random.default_rng(3).normal(size=(200_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index, asked = nearest.Index(len(x), 1.0, 1.0, 64), x[100:164]
    assert recall(x, index) < 0.93  # six probes
    score = asked @ x.T
    score[np.arange(64), np.arange(100, 164)] = -np.inf
    near = np.argpartition(-score, 19, axis=1)[:, :20]
    index.learn(asked, x[near.ravel()], np.repeat(np.arange(64), 20))
    assert index.probes > nearest.PROBES and recall(x, index) >= 0.93


def test_probes_are_learned_from_exact_answers(spark, monkeypatch):
    ship(spark)
    for name, value in (("TABLES", 2), ("PROBES", 1), ("BUCKET", 8)):
        monkeypatch.setattr(nearest, name, value)
    x = np.random.default_rng(4).normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    rows = nearest.valid(data, zero=False)
    index = nearest.Index(len(x), 1.0, 1.0, 32)
    nearest._learn([index], rows, rows.filter("vec_id % 20 = 0"), 20, 32)
    assert index.probes > 1
    score = x[::20] @ x.T
    score[np.arange(75), np.arange(0, 1500, 20)] = -np.inf
    near = np.argpartition(-score, 19, axis=1)[:, :20]
    home, probed = index.hashes(x[near.ravel()], False).reshape(75, 20, -1), index.hashes(x[::20], True)
    assert np.mean([np.isin(home[i], probed[i]).any(axis=1).mean() for i in range(75)]) >= 0.95


def test_uneven_norms(spark):
    ship(spark)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(51_282, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7] *= 20
    data = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    got = nearest.nearest(data.repartition(4), 800, 20).select("query_id", "vec_id").toPandas()
    asked = np.arange(0, len(x), 800)
    score = x[asked].astype(float) @ x.T.astype(float)
    score[np.arange(len(asked)), asked] = -np.inf
    near = np.argpartition(-score, 19, axis=1)[:, :20]
    assert np.mean([len(set(near[i]) & set(got["vec_id"][got["query_id"] == q])) / 20 for i, q in enumerate(asked)]) >= 0.95


def test_nearest_counts_repeated_ids_once(spark):
    ship(spark)
    x = np.random.default_rng(9).normal(size=(60, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] * 25 + [(3, (2 * x[3]).tolist())]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in nearest.nearest(data, 20, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    for q in (0, 20, 40):
        score = {i: max(x[q] @ y, 2 * (x[q] @ y) if i == 3 else -np.inf) for i, y in enumerate(x) if i != q}
        assert got[q] == sorted(score, key=lambda i: (-score[i], i))[:20]
    place, ids, best = nearest.top(np.array([9]), np.ones((1, 1)), np.array([5, 4, 5, 4, 1]), np.array([[3.0], [2.0], [4.0], [2.0], [1.0]]), 3)
    assert place.tolist() == [0, 0, 0] and ids.tolist() == [2, 1, 4] and best.tolist() == [4.0, 2.0, 1.0]


def test_norm_ranges():
    found = nearest.ranges([(1, 20.0, 20.0), (100, 10.0, 9.0), (3000, 1.0, 0.9), (300, 0.8, 0.7), (212, 0.5, 0.4)], 4)
    assert [(x.longest, x.shortest) for x in found] == [(20.0, 9.0), (1.0, 0.9), (0.8, 0.4)]
    v = np.zeros((5, 4))
    v[:, 0] = [20.0, 9.0, 0.95, 0.7, 0.4]
    assert nearest.range_of(v, found).tolist() == [0, 0, 1, 2, 2]


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(nearest.rotated(x, 3), axis=1), np.linalg.norm(x, axis=1))


RECORD = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def archived(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data, again = (h or "").encode(), i is not None and first[h or ""] != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    return Counter(out)


def test_archives(spark, sf):
    ship(spark)
    pages = table(spark, sf, "pages")
    assert Counter(tuple(r) for r in warc.round_trip(pages).collect()) == archived([(r["page_id"], None, r["html"]) for r in pages.collect()])
    rows = [(i, "http://x\r\ny", h) for i, h in enumerate([None, "", "a\r\n", "\r\n\r\n", RECORD, RECORD * 3, "WARC/1.1\r\nContent-Length: 99999\r\n\r\n", "é\n\r\n\r", None])]
    rows += [(None, None, "q"), (5, "u", "other")]
    made = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert Counter(tuple(r) for r in warc.round_trip(made.coalesce(1)).collect()) == archived(rows)
    assert warc.round_trip(made.limit(0)).count() == 0


def test_records_across_small_splits(spark, tmp_path):
    ship(spark)
    data, want = b"", {}
    for p in ["", RECORD * 2, "x" * 700, "\r\n\r\n", "WARC/1.1\r\nContent-Length: 70\r\n\r\n" * 3, "WARC/1.0\r\n", RECORD * 9, "end"]:
        want[len(data)] = p.encode()
        data += b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % len(p.encode()) + p.encode() + b"\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(data)
    (tmp_path / "cut.warc").write_bytes(data[:-20])
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        got = warc.read_archives(spark, str(tmp_path)).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r["offset"]: bytes(r["payload"]) for r in got if r["path"].endswith("a.warc")} == want
    assert len([r for r in got if r["path"].endswith("cut.warc")]) == len(want) - 1


def test_pipeline(spark, odd, sf):
    docs = table(spark, sf, "documents")
    packed = corpus_pipeline.run(spark, sf).collect()
    assert packed and {r["doc_id"] for r in packed} <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, odd, sf)
        assert out.columns == odd.columns, name
        assert out.count() <= odd.count()
