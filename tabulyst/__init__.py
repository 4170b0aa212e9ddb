"""Automatic analysis of tables on Spark."""

from tabulyst.config import AnalysisConfig
from tabulyst.plans.analysis import Analysis, analyse, run_analysis

__all__ = ["Analysis", "AnalysisConfig", "analyse", "run_analysis"]
