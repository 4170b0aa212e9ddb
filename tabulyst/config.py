"""Knobs of one analysis run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class AnalysisConfig:
    """Defaults of an analysis.

    ``sample_rows`` is off by default: the engine reads whole tables. The
    cardinality bounds are part of the meaning of the operators (they choose
    columns, never rows), so they stay on.
    """

    # They decide which columns an analysis shows.
    sample_rows: int | None = None
    topk_cols: int = 12
    topk_categories: int = 10
    max_numeric_plots: int = 3
    max_cat_plots: int = 3
    corr_max_features: int = 12
    missing_drop_threshold: float = 0.95
    random_seed: int = 42
    # a sketch instead of exact distinct counts, which shuffle every value
    approximate_distinct: bool = False
