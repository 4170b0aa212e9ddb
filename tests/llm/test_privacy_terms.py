"""Which terms disclose, counted in plain Python over whole tables."""

import math
from collections import Counter, defaultdict

import pytest
import regex

from tabulyst.llm import privacy
from tabulyst.llm.common import ship, table


def words(text):
    return {w for w in regex.split(r"[^\p{L}\p{N}]+", text) if regex.search(r"\p{L}", w)}


def digits(value):
    return regex.sub("[^0-9]", "", value)


def entities(row):
    out = set()
    for kind in privacy.KINDS:
        for s in row[kind]:
            v = s["value"]
            out.add(f"{kind}:{v.lower() if kind in ('email', 'ip') else digits(v)}")
            if kind == "email":
                out |= {f"email-name:{v.split('@')[0].lower()}", f"email-domain:{v.split('@')[-1].lower()}"}
            elif kind == "ip":
                out.add(f"ip-net:{'.'.join(v.split('.')[:3])}")
            else:
                out.add(f"{kind}-prefix:{digits(v)[:6]}")
    return out


def expected(rows):
    """{(doc_id, text): terms} from rows with base spans."""
    with_term, with_entity, both, seen = Counter(), Counter(), Counter(), {}
    for r in rows:
        if r["text"] in seen:
            continue
        rest = r["text"]
        for kind in privacy.KINDS:
            for s in r[kind]:
                rest = rest.replace(s["value"], " ")
        kinds = {k for k in privacy.KINDS if r[k]}
        seen[r["text"]] = (entities(r) | kinds, words(rest) if kinds else set())
        with_term.update(words(r["text"]))
        with_entity.update(seen[r["text"]][0])
        both.update((e, t) for e in seen[r["text"]][0] for t in seen[r["text"]][1])
    told = defaultdict(set)
    for (e, t), n in both.items():
        share = n / with_term[t]
        if n >= privacy.SUPPORT and share >= privacy.DISCLOSES and math.log2(share / (with_entity[e] / len(seen))) >= privacy.BITS:
            told[e].add(t)
    out = {}
    for r in rows:
        mine, terms = seen[r["text"]]
        if found := {t for e in mine for t in told[e]} & terms:
            out[r["doc_id"], r["text"]] = sorted(found)
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_terms_of_whole_tables(spark, folder):
    ship(spark)
    docs = table(spark, folder, "documents")
    found = privacy.find(docs).collect()
    want = expected(found)
    for r in found:
        terms = set(want.get((r["doc_id"], r["text"]), ()))
        assert {s["value"] for s in r["term"]} <= terms
        free = regex.sub("|".join([regex.escape(s["value"]) for k in privacy.KINDS for s in r[k]]) or r"(?!)", " ", r["text"])
        assert {s["value"] for s in r["term"]} >= {t for t in terms if t in words(free)} - {t for t in terms if t not in words(r["text"])}


def test_terms_of_made_texts(spark):
    rows = [(i, f"plain words number {i} and nothing else") for i in range(200)]
    rows += [(300 + i, f"李雷 写信 给 Lee о Кузнецов a{i}@one.example now") for i in range(4)]
    rows += [(400 + i, f"Lee is fine {i}") for i in range(1)] + [(300, rows[200][1]), (500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = privacy.find(docs).collect()
    want = expected([r for r in found if r["text"]])
    assert {"李雷", "写信", "给", "о", "Кузнецов"} <= set(want[301, rows[201][1]]) and "Lee" not in want[301, rows[201][1]]
    for r in found:
        assert sorted({s["value"] for s in r["term"]}) == want.get((r["doc_id"], r["text"]), [])


def test_many_matches_and_clashing_names(spark):
    text = "é " + " ".join(f"n{i}@x{i}.org" for i in range(5000)) + " 🙂 end@x.yz"
    docs = spark.createDataFrame([(1, text, "u", 7), (2, None, None, None)], "doc_id long, text string, `_` string, c2 int")
    found = privacy.find(docs)
    row = found.filter("doc_id = 1").first()
    assert len(row["email"]) == 5001
    assert all(text[s["start"] : s["end"]] == s["value"] for s in row["email"])
    back = privacy.rows_of(found, docs.columns, {"text": found["text"]})
    assert {(r["_"], r["c2"]) for r in back.collect()} == {("u", 7), (None, None)} and back.columns == docs.columns
