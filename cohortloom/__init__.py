"""Synthetic follow-up-call cohorts as Spark jobs.

Every operator is a function from DataFrames to DataFrames, deterministic by
seed and independent of how the input is partitioned.
"""

from cohortloom.settings import Settings

__all__ = ["Settings"]
