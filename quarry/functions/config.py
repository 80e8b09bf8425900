"""Configuration tables: feature flags and parameter-grid layers.

These operate on small configuration DataFrames (one row per flag or per
parameter), not on the data tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enabled_flags(flags: DataFrame, array_col: str = "flags") -> DataFrame:
    """From an array-of-tables column ``flags: array<struct<name, enabled>>``:
    number of flags, and the sorted names of the enabled ones."""
    return flags.select(
        F.size(array_col).alias("n_flags"),
        F.array_sort(F.transform(F.filter(array_col, lambda f: f["enabled"]), lambda f: f["name"])).alias("enabled"))
