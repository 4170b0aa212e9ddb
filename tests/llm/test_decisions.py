"""Decisions that hold at every size: language bars, the packing bound, empty vectors, and the
pipeline's stages against plain recounts."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tabulyst.llm import bitslices, language, nearest, packing, privacy, quality
from tabulyst.llm.common import ship, table


def plain_vector(text):
    """A document's vector, one trigram after the other."""
    letters = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    while "  " in letters:
        letters = letters.replace("  ", " ")
    total, many = np.zeros(language.WIDTH), 0
    for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
        if b == " ":
            continue
        one = language.letter_vectors(np.array([0 if x == " " else ord(x) for x in (a, b, c)])).astype(float)
        total += np.roll(one[0], 2) * np.roll(one[1], 1) * one[2]
        many += 1
    length = np.linalg.norm(total)
    return (total / length if length else total), many


def test_predictions_and_prototypes_by_plain_sums(spark):
    ship(spark)
    rows = table(spark, "/root/testdata/sf0.001", "documents").collect()
    vectors = {r["doc_id"]: plain_vector(r["text"][:1500]) for r in rows}
    docs = spark.createDataFrame([(r["doc_id"], r["text"][:1500], r["lang"]) for r in rows], "doc_id long, text string, lang string")
    known = language.prototypes(docs)
    for lang, prototype in known.items():
        total = sum(vectors[r["doc_id"]][0] for r in rows if r["lang"] == lang)
        assert np.allclose(prototype, total / np.linalg.norm(total), atol=1e-4)
    for r in language.classified(docs, known).collect():
        cosines = {lang: float(vectors[r["doc_id"]][0] @ p) for lang, p in known.items()}
        assert r["score"] == pytest.approx(max(0.0, max(cosines.values())), abs=1e-4)
        assert cosines[r["lang_pred"]] == pytest.approx(max(cosines.values()), abs=1e-4)


def test_short_texts_are_tested_too(spark):
    ship(spark)
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    known = language.prototypes(docs.select("text", "lang"))
    bars = language.least_scores(docs, known)
    assert (np.diff(bars) >= 0).all() and bars[-1] == language.LEAST_SCORE and bars[4] < bars[8]
    kept = language.accepted(docs, known, bars)
    with_letters = docs.filter("text rlike '\\\\p{L}'").count()
    assert kept.count() >= 0.995 * with_letters
    odd = [(1, "zqxj wvkq " * 8, None), (2, "ᚠᚢᚦᚨᚱᚲ ᚷᚹᚺᚾᛁᛃ " * 5, None), (3, "1234", None), (4, None, None)]
    odd = spark.createDataFrame(odd, "doc_id long, text string, lang string")
    assert language.accepted(odd, known, bars).count() == 0


def test_certified_partitions_exchange_too(spark):
    rng = random.Random(8)
    sizes = [rng.randint(1, 70) for _ in range(5000)]
    alone = sum(packing.best_fit(np.array(sizes[i : i + 100]), 100).max() + 1 for i in range(0, 5000, 100))
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "k long, length long")
    packed = packing.pack(rows, capacity=100, per_part=100)
    one = packing.certificate(packed, 100).first()
    assert one["at_least"] == packing.lower_bound(np.array(sizes), 100)
    assert one["at_least"] <= one["sequences"] <= one["at_least"] + 1 < alone
    load = {}
    for r in packed.orderBy("sequence_id", "offset").collect():
        assert r["offset"] == load.get(r["sequence_id"], 0)
        load[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(load.values()) <= 100 and sum(load.values()) == sum(sizes)


def test_empty_vectors(spark):
    ship(spark)
    rows = [(0, []), (1, [1.0, 2.0]), (2, []), (3, [-1.0, 0.5]), (4, None), (100, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in bitslices.top_products(vectors).collect()}
    assert got == {(q, v): 0 for q in (0, 100) for v in (0, 1, 2, 3, 100) if q != v}
    assert {r["query_id"] for r in nearest.nearest(vectors).collect()} == set()


def test_pipeline_stages_keep_what_they_should(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    stages = dict(corpus_pipeline.STAGES)
    ship(spark)
    # language: by a plain recount of vectors against the bars
    known = language.prototypes(docs.select("text", "lang"))
    bars = language.least_scores(docs, known)
    kept = {r["doc_id"] for r in stages["language"](spark, docs, sf).collect()}
    for r in docs.collect():
        if len(r["text"]) < 3000:
            v, many = plain_vector(r["text"])
            best = max((float(v @ p) for p in known.values()), default=0)
            bar = bars[int(np.log2(many))] if many else 2
            if abs(best - bar) > 1e-4:
                assert (r["doc_id"] in kept) == (many > 0 and best >= bar)
    # quality: the model's own rule
    model = quality.train(docs, quality.grades(table(spark, sf, "labels")))
    good = {r["doc_id"] for r in quality.rate(docs, model).collect() if r["p_good"] >= quality.SELECT}
    assert {r["doc_id"] for r in stages["quality"](spark, docs, sf).collect()} == good
    # personal data: every text rebuilt from the spans
    spans = {r["doc_id"]: r for r in privacy.find(docs).collect()}
    for r in stages["personal_data"](spark, docs, sf).collect():
        found = spans[r["doc_id"]]
        every = sorted((s["start"], s["end"]) for k in (*privacy.KINDS, "term") for s in found[k])
        assert r["n_chars"] == len(r["text"]) and (r["text"] == found["text"]) == (not every)


def shingle_set(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_stage(spark):
    sf, rng = "/root/testdata/sf0.001", random.Random(3)
    base = [" ".join(str(rng.randrange(500)) for _ in range(120)) for _ in range(12)]
    rows = [(i, t, "u") for i, t in enumerate(base)] + [(3, base[3], "u"), (3, base[5] + " tail", "u"), (3, "a text of its own " * 9, "u")]
    rows += [(None, base[7], None), (None, "without an id and alone in the table", None), (None, "", None), (50, None, "u"), (51, "", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_0 string")
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, sf)
    assert left.columns == docs.columns
    texts = [r["text"] for r in left.collect()]
    assert sum(not t for t in texts) == 3
    sets = [shingle_set(t) for t in texts if t]
    assert not any(len(a & b) >= 0.8 * len(a | b) for i, a in enumerate(sets) for b in sets[i + 1 :])
    for _, t, _ in rows:  # each text is there itself or by a near copy
        assert not t or any(len(shingle_set(t) & s) >= 0.8 * len(shingle_set(t) | s) for s in sets)
