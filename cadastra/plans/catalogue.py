"""All queries of the core package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadastra.plans import pipeline, problems, reference

MODULES = [problems, reference, pipeline]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.oracle_sql().items()}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.merge_all_survivors(spark, sf_dir)
