"""Personal data: base patterns, and terms that give away whom a text is about.

Base spans come from patterns, with Spark's functions alone. The protected entities are their
values, what values share (an e-mail's name part and domain, the first digits of a number, an
address's net) and their kinds, as most values stand in one text alone. Terms (words of a text) that stand in texts with an entity reveal it as far as the
corpus says so: I(term; entity) = log2 P(entity | term) / P(entity), estimated over all
documents. In a document that names an entity, a term whose P(entity | term) reaches
DISCLOSES on SUPPORT distinct texts or more, and which gives at least BITS bits, is
generalised or removed. Everything is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulyst.session import stage

#: The patterns. A run of letters is tried from its start alone (or from the
#: end of the last match), and nothing is given back where nothing could be gained: the
#: matches are those of the plain patterns, in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

DISCLOSES, SUPPORT, BITS = 0.9, 3, 4.0
#: Digits that a number shares with its like: a card's issuer, a phone's country and area.
PREFIX = 6

_SPANS = "array<struct<start:long,end:long,value:string>>"
#: Matches that are laid end to end at once: adding to an array copies it.
_PART = 64


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _found(text: Column, pattern: Column) -> Column:
    """All matches as (start, end, value) in code points: what lies between matches, and the
    matches, are laid end to end, first within parts of _PART matches, then part by part."""
    none = F.array().cast(_SPANS)
    return _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda hits: F.when(F.size(hits) == 0, none).otherwise(
        _let(F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(hits)), hits, lambda g, h: F.struct(F.char_length(g).cast("long").alias("g"), h.alias("h"))), _laid)))


def _laid(pairs: Column) -> Column:
    """Spans from the lengths of gaps and the matches that follow them."""
    def begun(spans: str) -> Column:
        return F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(spans).alias("out"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + x["g"]
        end = begin + F.char_length(x["h"])
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(F.struct(begin.alias("start"), end.alias("end"), x["h"].alias("value")))).alias("out"))

    def behind(a: Column, part: Column) -> Column:
        place = F.struct(a["at"].alias("at"), part["out"].alias("spans"))
        return F.struct((a["at"] + part["at"]).alias("at"), F.concat(a["out"], F.array(place)).alias("out"))

    numbers = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _PART).cast("int"))
    parts = F.transform(numbers, lambda k: F.aggregate(F.slice(pairs, k * _PART + 1, F.lit(_PART)), begun(_SPANS), step))
    placed = F.aggregate(parts, begun(f"array<struct<at:long,spans:{_SPANS}>>"), behind)["out"]
    return F.flatten(F.transform(placed, lambda p: F.transform(p["spans"], lambda s: F.struct(
        (s["start"] + p["at"]).alias("start"), (s["end"] + p["at"]).alias("end"), s["value"].alias("value")))))


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is 0 modulo 10."""
    reverse = F.split(F.reverse(digits), "")

    def weighed(d: Column, i: Column) -> Column:
        n = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(n > 9, n - 9).otherwise(n)

    return F.aggregate(F.transform(F.filter(reverse, lambda d: d != ""), weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _kept(kind: str):
    def length(v):
        return F.char_length(_digits(v))

    if kind == "ip":
        # leading zeros aside, a part over three digits is over 255
        return lambda s: F.forall(F.split(s["value"], r"\."), lambda p: F.char_length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
            F.split(s["value"], r"\."), lambda p: F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255)
    if kind == "card":
        return lambda s: (length(s["value"]) >= 13) & (length(s["value"]) <= 19) & _luhn(_digits(s["value"]))
    if kind == "phone":
        return lambda s: (length(s["value"]) >= 9) & (length(s["value"]) <= 15)
    return lambda s: F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, an array of (start, end, value) for each kind, and ``row``: the other
    columns, numbered (see ``rows_of``). Null texts are empty. A text without the characters that a kind needs is not
    searched for it."""
    rest = F.struct(F.lit(True).alias("_"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")))
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), rest.alias("row"))
    none = F.array().cast(_SPANS)
    needs = {"email": F.col("text").contains("@"), "ip": F.col("text").rlike(r"[0-9]\.[0-9]"), "card": F.col("text").rlike(r"(?:[0-9][\x20-]?){12}[0-9]"), "phone": F.col("text").rlike(r"\+[0-9]")}
    pattern = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))
    return docs.select("doc_id", "text", "row", *(
        F.when(needs[k], F.filter(_found(F.col("text"), F.lit(pattern[k])), _kept(k))).otherwise(none).alias(k) for k in KINDS))


def rows_of(found: DataFrame, columns: list[str], own: dict[str, Column]) -> DataFrame:
    """The rows that ``found`` was made from, with their ``columns``; ``own`` gives new values."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), **own}
    return found.select(*((own[c] if c in own else F.col("row").getField(f"c{i}")).alias(c) for i, c in enumerate(columns)))


def _entities(found: DataFrame) -> Column:
    """The protected values of a row, told apart by kind; blanks and signs don't count."""
    def name(kind: str):
        return lambda s: F.concat(F.lit(kind + ":"), F.lower(s["value"]) if kind in ("email", "ip") else _digits(s["value"]))

    return F.array_distinct(F.concat(*(F.transform(k, name(k)) for k in KINDS), *_shared()))


def _shared() -> list[Column]:
    """What values share with others, told apart by its form."""
    def first(kind: str):
        return lambda s: F.concat(F.lit(kind + "-prefix:"), F.substring(_digits(s["value"]), 1, PREFIX))

    return [
        F.transform("email", lambda s: F.concat(F.lit("email-name:"), F.lower(F.substring_index(s["value"], "@", 1)))),
        F.transform("email", lambda s: F.concat(F.lit("email-domain:"), F.lower(F.substring_index(s["value"], "@", -1)))),
        F.transform("ip", lambda s: F.concat(F.lit("ip-net:"), F.substring_index(s["value"], ".", 3))),
        F.transform("card", first("card")), F.transform("phone", first("phone")),
    ]


def _kinds() -> Column:
    """The kinds that a row has a value of."""
    return F.filter(F.array(*(F.when(F.size(k) > 0, F.lit(k)) for k in KINDS)), lambda k: k.isNotNull())


def _terms(text: Column) -> Column:
    """The distinct words of a text that can be terms: those with a letter, in any script."""
    words = F.array_distinct(F.split(text, r"[^\p{L}\p{N}]+"))
    return F.filter(words, lambda w: w.rlike(r"\p{L}"))


def _without(found: DataFrame) -> Column:
    """The text with base values blanked out, so that their parts are no terms."""
    text = F.col("text")
    for k in KINDS:
        text = F.aggregate(F.col(k), text, lambda t, s: F.replace(t, s["value"], F.lit(" ")))
    return text


def disclosing_terms(found: DataFrame) -> DataFrame:
    """``doc_id, copy, terms``: the terms of each document with an entity that disclose it.

    Counts are over distinct texts, so that copies add no evidence. Words of all texts are
    counted by a 64-bit hash, which sends one partial count for each word of a task.
    """
    copy = [F.xxhash64("text").alias("copy"), F.char_length("text").alias("size")]
    hashed = F.transform(_terms(F.col("text")), lambda t: F.xxhash64(t)).alias("hashes")
    # hashes are taken below the explode, or the text would be hashed anew for each word
    texts = found.select(*copy, hashed).groupBy("copy", "size").agg(F.first("hashes").alias("hashes"))
    counts = stage(texts.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("with_term")), "counts")
    total = found.select(*copy).distinct().count()
    marked = found.select("doc_id", *copy, _entities(found).alias("entities"), _kinds().alias("kinds"), _without(found).alias("rest"))
    naming = stage(marked.filter(F.size("entities") > 0).select("doc_id", "copy", "size", "entities", "kinds", _terms(F.col("rest")).alias("terms")), "naming")
    once = stage(naming.groupBy("copy", "size").agg(*(F.first(c).alias(c) for c in ("entities", "kinds", "terms"))), "once")
    of_entity = once.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("with_entity")).filter(F.col("with_entity") >= SUPPORT)
    # an entity that too few texts name can't be disclosed by enough of them
    frequent = stage(of_entity, "entities")
    pairs = once.select("terms", F.explode("entities").alias("entity")).join(frequent, "entity").select("entity", "with_entity", F.explode("terms").alias("term"))
    both = pairs.groupBy("entity", "term").agg(F.count("*").alias("both"), F.first("with_entity").alias("with_entity"))
    # the kinds are few and have many texts: they are counted without a join
    of_kind = once.select(*(F.count_if(F.array_contains("kinds", k)).alias(k) for k in KINDS)).first().asDict()
    with_kind = F.coalesce(*(F.when(F.col("entity") == k, F.lit(n)) for k, n in of_kind.items())).alias("with_entity")
    by_kind = once.select(F.explode("kinds").alias("entity"), "terms").select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("both"))
    both = stage(both.unionByName(by_kind.select("entity", "term", "both", with_kind)).filter(F.col("both") >= SUPPORT).withColumn("hash", F.xxhash64("term")), "both")
    share = F.col("both") / F.col("with_term")
    told = both.join(counts, "hash").filter(share >= DISCLOSES).filter(F.log2(share / (F.col("with_entity") / F.lit(max(total, 1)))) >= BITS)
    told = stage(told.select("entity", "term"), "told")
    # the terms that a document holds, of those that its entities and kinds are told by
    named = naming.select("doc_id", "copy", "terms", F.explode(F.concat("entities", "kinds")).alias("entity"))
    named = named.join(told.select("entity").distinct(), "entity", "left_semi").select("doc_id", "copy", "entity", F.explode("terms").alias("term"))
    mine = named.join(told, ["entity", "term"], "left_semi").select("doc_id", "copy", "term")
    return mine.groupBy("doc_id", "copy").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, arrays ``email, ip, card, phone, term`` of (start, end, value) and the
    other columns as ``row``, for each row of ``docs``. Null doc_ids and repeated rows are kept; rows without an id name no
    terms. A term that overlaps a base span is left out."""
    found = base_spans(docs)
    terms = stage(disclosing_terms(found.filter("doc_id is not null")), "disclosing")
    joined = found.withColumn("copy", F.xxhash64("text")).join(terms, ["doc_id", "copy"], "left")
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join("terms", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    base = F.concat(*KINDS)
    free = F.filter(_found(F.col("text"), pattern), lambda t: ~F.exists(F.col("base"), lambda s: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    return joined.withColumn("base", base).select("doc_id", "text", "row", *KINDS, F.when(F.col("terms").isNotNull(), free).otherwise(F.array().cast(_SPANS)).alias("term"))


def _joined(kinds: tuple[str, ...]) -> Column:
    def place(kind: str):
        return lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.concat(*(F.transform(F.array_sort(k), place(k)) for k in kinds)), ",")


def summary(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``, and ``n_term``."""
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in (*KINDS, "term")]
    return found.select("doc_id", *counts, F.sha2(_joined(KINDS), 256).alias("base_sha256"), _joined((*KINDS, "term")).alias("spans"))


def sanitised() -> Column:
    """The text with every span replaced: base values by their kind, terms by their form
    (a number, a name or a word). Overlapping spans become one, named by the first."""
    def replaced(kind: str):
        def by(s: Column) -> Column:
            form = F.when(s["value"].rlike("[0-9]"), "[code]").when(s["value"].rlike(r"^\p{Lu}"), "[name]").otherwise("[word]")
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), (form if kind == "term" else F.lit(f"[{kind}]")).alias("by"))

        return by

    every = F.concat(*(F.transform(k, replaced(k)) for k in (*KINDS, "term")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        out = F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(gap, s["by"]))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(F.array_sort(every), start, step)
    rest = F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.char_length("text"))
    return F.when(F.size(every) > 0, F.concat(F.array_join(done["out"], ""), rest)).otherwise(F.col("text"))
