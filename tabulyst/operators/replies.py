"""Reading model replies: a JSON object, plan fields, or a list of points in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a reply looks like and what it defaults to.
OBJECT_START = r"^\s*\{"
ARRAY_START = r"^\s*\["
FENCED_OBJECT = r"(?is)```json\s*(\{.*?\})\s*```"
OUTER_BRACES = r"(\{[\s\S]*\})"
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
OUTER_SPACE = f"^{SPACE}+|{SPACE}+$"
# a list mark, then a number, then its point
LINE_HEAD = f"^{SPACE}*[-*•]*{SPACE}*[0-9]*[.、)]*{SPACE}*"
LINE_EDGES = f"{LINE_HEAD}|{SPACE}+$"
POINT_FIELDS = ("insights", "bullets", "points")
MAX_POINTS = 6
DEFAULT_ANALYSES = ("payment_summary", "company_summary", "time_patterns")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, OUTER_SPACE, "")


def with_json_object(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the first JSON object of a text as a variant, else null.

    The whole text is tried first, then a fenced block, then what lies between
    the outermost braces.
    """
    t = F.col(text)
    whole = F.when(t.rlike(OBJECT_START), F.try_parse_json(t))
    fenced = F.try_parse_json(F.regexp_extract(t, FENCED_OBJECT, 1))
    braces = F.try_parse_json(F.regexp_extract(t, OUTER_BRACES, 1))
    return df.withColumn(out, F.coalesce(whole, fenced, braces))


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("MISSING"))


def truthy(v: Column, path: str) -> Column:
    """Whether a JSON field is set to something: not null, false, zero or empty."""
    item = F.try_variant_get(v, path, "variant")
    kind = _kind(item)
    return (
        F.when(kind.isin("MISSING", "VOID"), False)
        .when(kind == "BOOLEAN", F.try_variant_get(v, path, "boolean"))
        .when(kind == "STRING", F.length(F.try_variant_get(v, path, "string")) > 0)
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(v, path, "array<variant>")) > 0)
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .otherwise(F.coalesce(F.try_variant_get(v, path, "double") != 0.0, F.lit(True)))
    )


def with_plan(df: DataFrame, text: str, stop_default: bool = False) -> DataFrame:
    """Adds extra_analyses, stop and insights_md of a reply, with defaults."""
    read = with_json_object(df, text, "__obj").withColumns({
        "__asked": F.try_variant_get("__obj", "$.extra_analyses", "variant"),
        "__stop": F.try_variant_get("__obj", "$.stop", "variant"),
    })
    listed = F.try_variant_get("__obj", "$.extra_analyses", "array<string>")
    default = F.array(*[F.lit(a) for a in DEFAULT_ANALYSES])
    none = F.array().cast("array<string>")
    return read.withColumns({
        "extra_analyses": F.when(F.col("__asked").isNull(), default).otherwise(F.coalesce(listed, none)),
        "stop": F.when(F.col("__stop").isNotNull(), truthy(F.col("__obj"), "$.stop"))
        .otherwise(F.lit(stop_default)),
        "insights_md": F.coalesce(F.try_variant_get("__obj", "$.llm_insights_md", "string"), F.lit("")),
    }).drop("__obj", "__asked", "__stop")


def _filled(items: Column) -> Column:
    return F.filter(F.transform(items, strip), lambda x: F.length(x) > 0)


def _line_points(text: Column) -> Column:
    """Lines of a text without list marks and numbers, repeats left out."""
    lines = F.transform(F.split(text, LINE_BREAK), lambda x: F.regexp_replace(x, LINE_EDGES, ""))
    return F.array_distinct(F.filter(lines, lambda x: F.length(x) > 0))


def with_points(df: DataFrame, text: str, out: str, most: int = MAX_POINTS) -> DataFrame:
    """Adds a reply's points: a JSON array, an object's list, or else its lines.

    Each step is a column of its own, so that a text is parsed once however many
    fields are looked up in it.
    """
    is_array, is_object = F.col("__text").rlike(ARRAY_START), F.col("__text").rlike(OBJECT_START)
    in_object = F.lit(None).cast("array<string>")
    for name in reversed(POINT_FIELDS):
        path = f"$.{name}"
        in_object = F.when(
            truthy(F.col("__json"), path), F.try_variant_get("__json", path, "array<string>")
        ).otherwise(in_object)
    steps = {
        "__text": strip(F.coalesce(F.col(text), F.lit(""))),
        "__json": F.when(is_array | is_object, F.try_parse_json("__text")),
        "__listed": F.when(is_array, F.try_variant_get("__json", "$", "array<string>"))
        .when(is_object, in_object),
        "__points": F.when(F.col("__listed").isNull(), _line_points(F.col("__text")))
        .otherwise(_filled(F.col("__listed"))),
    }
    for name, step in steps.items():
        df = df.withColumn(name, step)
    return df.withColumn(out, F.slice("__points", 1, most)).drop(*steps)


def merge_points(first: Column, second: Column) -> Column:
    """Both lists in order, trimmed, blanks and repeats left out."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(_filled(F.concat(F.coalesce(first, empty), F.coalesce(second, empty))))


def digest(dataset: DataFrame, rates: DataFrame, tests: DataFrame, found: DataFrame, worst: int = 8) -> DataFrame:
    """One row: the analysis in short, as JSON text.

    Every part is bounded: the worst columns, at most one test of each kind, the
    findings.
    """
    def listed(df: DataFrame, name: str, order: str, columns: list[str]) -> DataFrame:
        items = F.collect_list(F.struct(order, F.struct(*columns).alias("item")))
        return df.agg(F.transform(F.array_sort(items), lambda x: x["item"]).alias(name))

    top = rates.orderBy(F.desc("missing_rate"), "position").limit(worst)
    parts = [
        dataset.select(F.to_json(F.struct(*dataset.columns)).alias("json"), F.lit("dataset").alias("part")),
    ]
    by_rate = top.withColumn("order", F.struct(-F.col("missing_rate"), "position"))
    named = ["name", "missing_rate", *(["role"] if "role" in rates.columns else [])]
    for df, part, order, columns in (
        (by_rate, "top_missing_cols", "order", named),
        (tests, "tests", "test", ["test", "x", "y", "statistic", "p_value", "p_value_fmt"]),
        (found, "rule_insights", "place", ["message"]),
    ):
        one = listed(df, "items", order, columns)
        parts.append(one.select(F.to_json("items").alias("json"), F.lit(part).alias("part")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("part", "json")
