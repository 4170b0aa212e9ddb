"""The whole analysis of one table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulyst.config import AnalysisConfig
from tabulyst.operators import charts, cleaning, diagnostics, features, model, profile, stat_tests
from tabulyst.operators import findings as fnd
from tabulyst.operators import replies
from tabulyst.operators import roles as R
from tabulyst.operators.summaries import SUMMARY_KINDS, summaries
from tabulyst.session import stage
from tabulyst.sources.readers import read_csv, read_parquet
from tabulyst.sources.sinks import write_parts


@dataclass
class Analysis:
    """The parts of an analysis, each a DataFrame, and the cleaned table."""

    run_id: str
    roles: dict[str, str]
    clean: DataFrame
    parts: dict[str, DataFrame] = field(default_factory=dict)

    def save(self, folder: str) -> None:
        write_parts(self.parts, folder)


def load(spark: SparkSession, path: str, cfg: AnalysisConfig = AnalysisConfig()) -> DataFrame:
    """A table from CSV or parquet.

    A parsed CSV is written once as a columnar table, because every operator
    would otherwise parse all the text again.
    """
    if path.rstrip("/").endswith(".parquet"):
        return read_parquet(spark, path, cfg.sample_rows)
    return stage(read_csv(spark, path, cfg.sample_rows), "raw")


def analyse(
    raw: DataFrame, name: str, target: str | None = None, cfg: AnalysisConfig = AnalysisConfig(),
    extras: Sequence[str] = SUMMARY_KINDS,
) -> Analysis:
    """Roles, profile, cleaning, charts, tests, findings, summaries and the model."""
    spark = raw.sparkSession
    roles = R.infer_roles(raw)
    parts = {"columns": profile.column_profile(raw, roles, cfg)}
    clean, kept_roles, log = cleaning.clean(raw, roles, cfg)
    featured, log.added_features = features.add_features(clean, kept_roles)
    parts["cleaning"] = log.frame(spark)
    # the label of the run and of its time are facts of the run, not of the data
    stamp = datetime.now()
    run_id = f"{stamp:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"
    parts["dataset"] = profile.dataset_profile(raw).select(
        F.lit(run_id).alias("run_id"),
        F.lit(stamp.isoformat(timespec="seconds")).alias("generated_at"),
        F.lit(name).alias("filename"), "n_rows", "n_cols", "memory_mb",
        F.col("n_rows").alias("loaded_rows"),
    )
    parts["footprint"] = profile.footprint(raw)
    parts["missing_chart"] = profile.top_missing(raw, cfg.topk_cols)
    shown = charts.histogram_columns(clean, kept_roles, cfg.max_numeric_plots)
    parts["histograms"] = charts.histogram(clean, shown)
    related = charts.correlation_columns(clean, kept_roles, cfg.corr_max_features)
    if len(related) >= 2:
        parts["correlations"] = charts.correlation_matrix(clean, related)
    parts["category_bars"] = charts.category_bars(clean, kept_roles, cfg)
    tests = stat_tests.run_tests(clean, kept_roles)
    # three rows at most, used by the findings too
    tests = spark.createDataFrame(tests.collect(), tests.schema)
    parts["tests"] = tests
    parts["insights"] = fnd.findings(
        profile.missing_rates(raw), log.frame(spark).select("dropped_duplicates"), tests
    )
    for key, df in summaries(raw, extras).items():
        parts[f"summary_{key}"] = df
    if target:
        fitted = model.fit_baseline(featured, target, cfg)
        parts["model"] = fitted.frame(spark)
        if fitted.record.get("task_type") == "regression":
            found = _diagnosed(featured, target)
            parts["ols_fit"] = found.fit_frame(spark)
            parts["ols_coefficients"] = found.coefficient_frame(spark)
            parts["vif"] = found.vif_frame(spark)
    return Analysis(run_id, kept_roles, clean, parts)


def _diagnosed(df: DataFrame, target: str) -> diagnostics.Diagnostics:
    try:
        return diagnostics.diagnose(df, target)
    except Exception as problem:  # the model stands even when its diagnostics do not
        return diagnostics.Diagnostics(error=repr(problem))


def run_analysis(
    spark: SparkSession, path: str, output: str, target: str | None = None,
    cfg: AnalysisConfig = AnalysisConfig(), extras: Sequence[str] = SUMMARY_KINDS,
) -> Analysis:
    """Analyse the table at ``path`` and save the parts under ``output``."""
    raw = load(spark, path, cfg)
    done = analyse(raw, path.rstrip("/").rsplit("/", 1)[-1], target, cfg, extras)
    done.save(f"{output.rstrip('/')}/{done.run_id}")
    return done


def digest_of(analysis: Analysis) -> DataFrame:
    """The analysis in short, for a reader that takes JSON."""
    p = analysis.parts
    return replies.digest(p["dataset"], p["columns"], p["tests"], p["insights"])
