"""lendgrade: loan-application cleaning, quarantine and loan scoring on Spark.

Every operator is a lazy DataFrame -> DataFrame function built from Spark's
own expressions; see README.md for the operator map.
"""

from .config import DEFAULT_CONFIG, GradeCutoffs, Layout, Points, ScoreConfig, Weights

__all__ = ["DEFAULT_CONFIG", "GradeCutoffs", "Layout", "Points", "ScoreConfig", "Weights"]
