"""Group summaries by payment, company, hour and weekday, on the raw table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.functions import scalars as S
from tabulyst.functions.names import preferred_column
from tabulyst.functions.scalars import col
from tabulyst.operators.selection import exact_quantiles

# The column names looked for, the table sizes, the labels.
PAYMENT_NAMES = ("Payment Type", "payment_type")
COMPANY_NAMES = ("Company", "company")
FARE_NAMES = ("Fare", "fare")
TIP_NAMES = ("Tips", "tip", "tips")
TOTAL_NAMES = ("Trip Total", "total")
MILES_NAMES = ("Trip Miles", "miles")
SECONDS_NAMES = ("Trip Seconds", "seconds", "duration")
TIME_NAMES = ("Trip Start Timestamp", "start_time", "timestamp", "datetime")
TOP_PAYMENTS = 12
TOP_COMPANIES = 10
UNKNOWN = "Unknown"
RATE_GUARD = 1e-9
SUMMARY_KINDS = ("payment_summary", "company_summary", "time_patterns")


@dataclass(frozen=True)
class TripColumns:
    """Which columns of a table play the parts a summary needs."""

    payment: str | None
    company: str | None
    start: str | None
    fare: str | None
    tips: str | None
    total: str | None
    miles: str | None
    seconds: str | None

    @classmethod
    def of(cls, df: DataFrame) -> TripColumns:
        def pick(wanted: Sequence[str]) -> str | None:
            return preferred_column(df.columns, wanted)

        return cls(
            pick(PAYMENT_NAMES), pick(COMPANY_NAMES), pick(TIME_NAMES), pick(FARE_NAMES),
            pick(TIP_NAMES), pick(TOTAL_NAMES), pick(MILES_NAMES), pick(SECONDS_NAMES),
        )

    @property
    def money(self) -> list[str]:
        return [c for c in (self.fare, self.tips, self.total) if c]

    @property
    def trip(self) -> list[str]:
        return [c for c in (self.miles, self.seconds) if c]

    @property
    def metrics(self) -> list[str]:
        return self.money + self.trip


def _number(df: DataFrame, name: str) -> Column:
    return S.to_number(col(name), df.schema[name].dataType)


def _means(df: DataFrame, metrics: Sequence[str]) -> list[Column]:
    return [F.avg(_number(df, m)).alias(f"{m}_mean") for m in metrics]


def group_means_medians(
    df: DataFrame, key: str, metrics: Sequence[str], top: int,
    rate: tuple[str, str] | None = None,
) -> DataFrame:
    """The ``top`` largest groups with count, mean and exact median per metric.

    Counts and means come from one aggregation, of which only the largest groups
    are kept; the medians are then found for those groups alone.
    """
    order = [F.desc("count"), col(key).asc_nulls_first()]
    largest = (
        df.groupBy(col(key)).agg(F.count("*").alias("count"), *_means(df, metrics))
        .orderBy(*order).limit(top)
    )
    kept = largest.collect()  # at most `top` rows
    within = df.where(_one_of(key, [r[0] for r in kept])).select(
        col(key), *[_number(df, m).alias(m) for m in metrics]
    )
    found = exact_quantiles(within, {m: col(m) for m in metrics}, [0.5], [key])
    rows = [
        tuple(r) + tuple(found.get(m, 0.5, (r[0],)) for m in metrics) for r in kept
    ]
    schema = T.StructType(
        list(largest.schema) + [T.StructField(f"{m}_median", T.DoubleType()) for m in metrics]
    )
    out = df.sparkSession.createDataFrame(rows, schema)
    columns = [col(key), F.col("count")]
    for m in metrics:
        columns += [col(f"{m}_mean"), col(f"{m}_median")]
    if rate:
        part, whole = (col(f"{m}_mean") for m in rate)
        columns.append(F.try_divide(part, whole + F.lit(RATE_GUARD)).alias("tip_rate_mean"))
    return out.select(*columns).orderBy(*order)


def _one_of(key: str, values: Sequence) -> Column:
    """A filter on a top-k of keys, null among them; it reaches the scan."""
    listed = col(key).isin([v for v in values if v is not None])
    return listed | col(key).isNull() if None in values else listed


def payment_money(df: DataFrame) -> DataFrame | None:
    t = TripColumns.of(df)
    if not (t.payment and t.money):
        return None
    rate = (t.tips, t.total) if t.tips and t.total else None
    return group_means_medians(df, t.payment, t.money, TOP_PAYMENTS, rate)


def payment_trip(df: DataFrame) -> DataFrame | None:
    t = TripColumns.of(df)
    if not (t.payment and t.trip):
        return None
    return group_means_medians(df, t.payment, t.trip, TOP_PAYMENTS)


def company(df: DataFrame) -> DataFrame | None:
    """Means per company for the companies with most rows.

    Missing companies are chosen together with the literal label "Unknown" but
    listed apart, so a label holds two groups at most. One aggregation of the
    table serves both the choice and the listing.
    """
    t = TripColumns.of(df)
    if not (t.company and t.metrics):
        return None
    key = col(t.company)
    groups = df.groupBy(key).agg(F.count("*").alias("count"), *_means(df, t.metrics))
    record = F.struct(*[col(c) for c in groups.columns])
    chosen = (
        groups.groupBy(F.coalesce(key.cast("string"), F.lit(UNKNOWN)).alias("__label"))
        .agg(F.sum("count").alias("__rows"), F.collect_list(record).alias("__groups"))
        .orderBy(F.desc("__rows"), "__label")
        .limit(TOP_COMPANIES)
    )
    listed = chosen.select(F.inline("__groups"))
    return listed.orderBy(F.desc("count"), key.asc_nulls_first())


def time_pattern(df: DataFrame, part: str) -> DataFrame | None:
    """Count and means by ``hour`` or ``dow`` (Monday is 0); unread times dropped."""
    t = TripColumns.of(df)
    if not (t.start and t.metrics):
        return None
    ts = S.to_time(col(t.start), df.schema[t.start].dataType)
    unit = {"hour": F.hour, "dow": F.weekday}[part](ts)
    return (
        df.where(ts.isNotNull())
        .groupBy(unit.alias(part))
        .agg(F.count("*").alias("count"), *_means(df, t.metrics))
        .orderBy(part)
    )


def summaries(
    df: DataFrame, wanted: Sequence[str] = SUMMARY_KINDS
) -> dict[str, DataFrame]:
    """The requested summaries that the table's columns allow."""
    makers = {
        "payment_summary": {"payment_money": payment_money, "payment_trip": payment_trip},
        "company_summary": {"company": company},
        "time_patterns": {
            "hour": lambda d: time_pattern(d, "hour"), "dow": lambda d: time_pattern(d, "dow"),
        },
    }
    chosen = {n: fn for kind, fns in makers.items() if kind in set(wanted) for n, fn in fns.items()}
    built = {n: fn(df) for n, fn in chosen.items()}
    return {n: d for n, d in built.items() if d is not None}


def group_moments(df: DataFrame, key: str, value: str, least: int = 5) -> DataFrame:
    """Groups with enough rows, in no order, with the moments of a value."""
    x = _number(df, value)
    return (
        df.where(col(key).isNotNull()).groupBy(col(key).alias("key"))
        .agg(F.count("*").alias("size"), F.count(x).alias("n"), F.avg(x).alias("mean"),
             F.var_samp(x).alias("variance"))
        .where(F.col("size") >= least)
    )


def sizeable_groups(df: DataFrame, key: str, value: str, least: int = 5) -> DataFrame:
    """The same groups in key order."""
    return group_moments(df, key, value, least).orderBy("key")
