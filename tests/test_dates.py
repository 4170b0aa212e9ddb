"""Date formats learnt from columns."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulyst.operators import cleaning, dates
from tabulyst.operators import roles as R

DAYS = [datetime.datetime(2021, 1, 1) + datetime.timedelta(days=7 * i, hours=i % 24, minutes=30) for i in range(60)]


@pytest.mark.parametrize("form, shown, exact", [
    ("%d.%m.%Y", "9.9.9", "d.M.yyyy"), ("%d/%m/%Y", "9/9/9", "d/M/yyyy"), ("%m/%d/%Y", "9/9/9", "M/d/yyyy"),
    ("%d-%m-%y", "9-9-9", "d-M-yy"), ("%Y.%m.%d", "9.9.9", "yyyy.M.d"), ("%d/%m/%Y %H:%M", "9/9/9 9:9", "d/M/yyyy H:mm"),
    ("%d/%m/%Y %I:%M:%S %p", "9/9/9 9:9:9 A", "d/M/yyyy h:mm:ss a"), ("%d %B %Y", "9 A 9", "d MMM yyyy|d MMMM yyyy"),
    ("%b %d, %Y", "A 9, 9", "MMM d, yyyy|MMMM d, yyyy"), ("%d-%b-%Y", "9-A-9", "d-MMM-yyyy|d-MMMM-yyyy"), ("%d. %B %Y", "9. A 9", "d. MMM yyyy|d. MMMM yyyy"),
])
def test_formats(spark, form, shown, exact):
    texts = [d.strftime(form) for d in DAYS]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("soon",)], "start_date string").repartition(3)
    formats = dates.learn_formats(df, ["start_date"])["start_date"]
    assert formats[shown] == exact
    assert R.infer_roles(df) == {"start_date": R.DATETIME}
    got = {(r["start_date"], r["x"]) for r in df.select("start_date", dates.read_times(F.col("start_date"), T.StringType(), formats).alias("x")).collect()}
    assert got == {(t, datetime.datetime.strptime(t, form)) for t in texts} | {(None, None), ("soon", None)}
    cast = cleaning.cast_to_roles(df, {"start_date": R.DATETIME})
    assert cast.filter("start_date is not null").count() == 60


def test_short_years(spark):
    df = spark.createDataFrame([("30-12-68",), ("31-12-69",), ("29-02-96",), ("15-06-00",)], "date string")
    formats = dates.learn_formats(df, ["date"])["date"]
    got = {r[0] for r in df.select(F.year(dates.read_times(F.col("date"), T.StringType(), formats))).collect()}
    assert got == {2068, 1969, 1996, 2000}


def test_orders_without_votes(spark):
    df = spark.createDataFrame([("01.02.2020", "01/02/2020")] * 5, "date_a string, date_b string")
    found = dates.learn_formats(df, df.columns)
    assert found == {"date_a": {"9.9.9": "d.M.yyyy"}, "date_b": {"9/9/9": "M/d/yyyy"}}


def test_other_shapes_are_read_as_before(spark):
    df = spark.createDataFrame([("2020-05-06 07:08:09",), ("13/02/2020",), ("no date",), ("x" * 100,), (None,)], "date string")
    formats = dates.learn_formats(df, ["date"])["date"]
    got = [r[0] for r in df.select(dates.read_times(F.col("date"), T.StringType(), formats)).collect()]
    assert got[:3] == [datetime.datetime(2020, 5, 6, 7, 8, 9), datetime.datetime(2020, 2, 13), None] and got[3:] == [None, None]
    assert dates.learn_formats(df, []) == {}
    assert dates.learn_formats(df.filter("false"), ["date"]) == {"date": {}}
