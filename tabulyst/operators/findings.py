"""Rule-based findings from the profile, the cleaning and the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Thresholds and the sentences of the findings.
MISSING_ALERT = 0.3
SIGNIFICANT = 0.05
MISSING_TEXT = "缺失率最高的列是 `%s`（missing_rate=%.2f%%），建议确认采集流程或考虑剔除/重采样。"
DUPLICATES_TEXT = "检测到并移除了重复行 %d 条，后续分析基于去重后的数据。"
TEST_TEXT = "统计检验 `%s` 显示 `%s` 与 `%s` 存在显著关系（p=%s）。"
NOTHING_TEXT = "未发现特别突出的缺失/重复/显著关系信号（可能需要指定目标列或更细分的业务问题）。"


def missing_finding(rates: DataFrame) -> DataFrame:
    """From (position, name, missing_rate): the worst column if it is bad enough."""
    worst = rates.orderBy(F.desc("missing_rate"), "position").limit(1)
    return worst.where(F.col("missing_rate") > MISSING_ALERT).select(
        F.lit(1).alias("place"), F.lit("missing").alias("kind"), F.col("name").alias("subject"),
        F.format_string(MISSING_TEXT, "name", F.col("missing_rate") * 100.0).alias("message"),
    )


def duplicates_finding(counts: DataFrame) -> DataFrame:
    """From a row with dropped_duplicates."""
    return counts.where(F.col("dropped_duplicates") > 0).select(
        F.lit(2).alias("place"), F.lit("duplicates").alias("kind"),
        F.lit(None).cast("string").alias("subject"),
        F.format_string(DUPLICATES_TEXT, "dropped_duplicates").alias("message"),
    )


def test_findings(tests: DataFrame) -> DataFrame:
    """From test results: one finding for each significant one."""
    order = F.when(F.col("test") == "pearsonr", 3).when(F.col("test") == "chi2", 5).otherwise(4)
    return tests.where(F.col("p_value") < SIGNIFICANT).select(
        order.alias("place"), F.lit("test").alias("kind"), F.col("test").alias("subject"),
        F.format_string(TEST_TEXT, "test", "x", "y", "p_value_fmt").alias("message"),
    )


def findings(rates: DataFrame, counts: DataFrame, tests: DataFrame) -> DataFrame:
    """(place, kind, subject, message) in order; a closing sentence if none apply."""
    closing = rates.sparkSession.createDataFrame(
        [(9, "none", None, NOTHING_TEXT)], "place int, kind string, subject string, message string"
    )
    found = missing_finding(rates).unionByName(duplicates_finding(counts)) \
        .unionByName(test_findings(tests)).unionByName(closing)
    # a handful of rows: counted in place, so that the inputs are computed once
    alone = F.count("*").over(W.partitionBy(F.lit(1))) == 1
    kept = found.withColumn("alone", alone).where((F.col("kind") != "none") | F.col("alone"))
    return kept.drop("alone").orderBy("place")
