"""The tables the registered queries read: the given ones and views over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulyst.session import stage
from tabulyst.sources.readers import read_parquet


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item, with gaps, a sparse column, dirty text and a code.

    No side is marked for broadcast: orders and suppliers grow with the data, so
    the optimizer decides by their measured size.
    """
    joined = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, folder, "supplier"), F.expr("l_suppkey = s_suppkey"))
    )
    return joined.selectExpr(
        "l_orderkey as trip_key",
        "l_linenumber as leg",
        "l_shipdate + make_dt_interval(0, cast((l_orderkey*7 + l_linenumber) % 24 as int))"
        " as trip_start_timestamp",
        "case when (l_orderkey*13 + l_linenumber) % 11 = 0 then null else o_orderpriority end"
        " as payment_type",
        "case when (l_orderkey + l_linenumber) % 17 = 0 then null else s_name end as company",
        "l_extendedprice as fare",
        "case when (l_orderkey*3 + l_linenumber) % 9 = 0 then null"
        " else l_extendedprice * l_discount end as tips",
        "l_extendedprice * (1D + l_discount + l_tax) as trip_total",
        "l_quantity as trip_miles",
        "case when (l_orderkey + l_linenumber*5) % 13 = 0 then null"
        " else l_quantity * 60D + cast(l_suppkey as double) end as trip_seconds",
        "case when (l_orderkey + l_linenumber) % 50 = 0 then 1D end as mostly_missing",
        "case when l_linenumber % 2 = 0 then cast(l_quantity as string)"
        " when (l_orderkey + l_linenumber) % 10 = 1 then 'bad'"
        " else cast(l_tax as string) end as miles_text",
        "l_suppkey as pickup_zone_code",
    )


def staged_trips(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The trips, or some of their columns, joined and written once: for operators that read
    their table several times, which would shuffle the line items and orders each time."""
    df = trips(spark, folder)
    return stage(df.select(*columns) if columns else df, "trips")


# How many columns each metric of the wide trips gives.
WIDE_VARIANTS = 14


def wide_column(metric: str, k: int) -> tuple[str, str]:
    """Name and SQL, in Spark's and DuckDB's dialects, of a scaled metric with gaps of its own."""
    sql = f"case when (trip_key * {k + 3} + leg) % {k + 5} = 0 then null else {metric} * cast(trip_key % {k + 2} + 1 as double) end"
    return f"{metric}_{k}", sql


def wide_trips(spark: SparkSession, folder: str, metrics: Sequence[str]) -> DataFrame:
    """Trips as many numeric columns, all with gaps."""
    columns = [wide_column(m, k) for k in range(WIDE_VARIANTS) for m in metrics]
    return trips(spark, folder).selectExpr(*(f"{sql} as {name}" for name, sql in columns))


def wide_design(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a price and 40 columns: 36 that follow it more or less, two constants, a
    copy of the third and a multiple of the fifth."""
    columns = [
        f"cast((l_orderkey * {k + 3} + l_partkey * {2 * k + 1}) % {101 + k} as double) * {900 + 40 * ((k * 7) % 36)}D + l_extendedprice as d{k}"
        for k in range(36)
    ]
    return table(spark, folder, "lineitem").selectExpr("l_extendedprice", *columns, "7D as c1", "cast(null is null as double) as c2",
                                                       f"{columns[2].rsplit(' as ', 1)[0]} as copy", f"3D * ({columns[4].rsplit(' as ', 1)[0]}) as multiple")


def repeated_trips(spark: SparkSession, folder: str, staged: bool = False) -> DataFrame:
    """Trips with their first legs a second time; with ``staged`` the trips are written once."""
    copies = F.expr("explode(array_repeat(0, case when leg = 1 then 2 else 1 end))")
    df = staged_trips(spark, folder) if staged else trips(spark, folder)
    return df.select("*", copies.alias("copy")).drop("copy")


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation turn as a reply in one of four written forms."""
    plain = "replace(text, '\"', '')"
    items = f"replace({plain}, '\\n', '\",\"')"
    return table(spark, folder, "conversations").selectExpr(
        "conv_id",
        "turn",
        "case turn % 4"
        " when 0 then text"
        " when 1 then concat('1. ', replace(text, '\\n', '\\n- '))"
        f" when 2 then concat('[\"', {items}, '\"]')"
        f" else concat('{{\"points\": [\"', {items}, '\"]}}') end as text",
    )


def plan_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a reply that carries its JSON bare, fenced, in prose or broken."""
    body = "concat('{\"extra_analyses\": [\"', event_type, '\"], \"stop\": ', " \
           "case when value > 20 then 'true' else 'false' end, ', \"props\": ', props, '}')"
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "case event_id % 5"
        f" when 0 then {body}"
        f" when 1 then concat('Plan:\\n```json\\n', {body}, '\\n```\\nDone.')"
        f" when 2 then concat('We suggest ', {body}, ' as the next step.')"
        " when 3 then concat('{broken ', props)"
        " else concat('No further work for ', event_type, '.') end as text",
    )
