"""Rows by their place in the files."""

import shutil

import pytest

from tabulyst.sources import positions
from tabulyst.sources.readers import read_csv, read_parquet


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("files") / "a folder é")
    rows = spark.range(5000).selectExpr("id as k", "cast(id * 0.5 as double) as x", "concat('text ', id) as t")
    rows.repartitionByRange(23, "k").sortWithinPartitions("k").write.mode("overwrite").option("parquet.block.size", 4096).parquet(f"{path}/p")
    rows.repartitionByRange(9, "k").sortWithinPartitions("k").write.mode("overwrite").option("header", True).csv(f"{path}/c")
    return path


@pytest.mark.parametrize("split", ["128m", "2k"])
@pytest.mark.parametrize("n", [0, 1, 217, 218, 3000, 4999, 5000, 9000])
def test_first_rows(spark, folder, n, split):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for df in (read_parquet(spark, f"{folder}/p", n), read_csv(spark, f"{folder}/c", n)):
            assert sorted(r["k"] for r in df.collect()) == list(range(min(n, 5000)))
            assert df.columns == ["k", "x", "t"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_positions_of_all_rows(spark, folder):
    found = positions.row_positions(read_parquet(spark, f"{folder}/p"), "at").collect()
    assert {(r["k"], r["at"]) for r in found} == {(i, i) for i in range(5000)}


def test_few_files_are_read(spark, folder, tmp_path):
    """The last files can't be read; the first rows need none of them."""
    shutil.copytree(f"{folder}/p", tmp_path / "p")
    for broken in sorted((tmp_path / "p").glob("part-*"))[5:]:
        broken.write_bytes(b"no parquet")
    assert {r["k"] for r in read_parquet(spark, str(tmp_path / "p"), 10).collect()} == set(range(10))


def test_positions_among_filtered_rows(spark, folder):
    odd = read_parquet(spark, f"{folder}/p").filter("k % 3 = 1")
    assert sorted(r["k"] for r in positions.first_rows(odd, 100).collect()) == [1 + 3 * i for i in range(100)]


def test_rows_without_files(spark):
    df = spark.createDataFrame([(i,) for i in range(9)], "k long")
    assert not positions.from_files(df) and positions.first_rows(df, 4).count() == 4
    assert not positions.from_files(df.groupBy("k").count())
