"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` with an
optional DuckDB SQL oracle over the same parquet tables."""

from quarry.plans.registry import ORACLE, QUERIES, load_all

__all__ = ["ORACLE", "QUERIES", "load_all"]
