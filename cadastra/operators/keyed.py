"""Keyed tables: deduplication, upserts, slice replacement, fill-blank updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in `order`; rows that tie in `order` are settled by Spark's sort, so make it total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def keep_best(df: DataFrame, keys: Sequence[str], status: str, ranks: dict[str, int], confidence: str, order: str) -> DataFrame:
    """One row per key: best status, then highest confidence, then the later row; unknown statuses come last."""
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv]), F.col(status)), F.lit(max(ranks.values()) + 1))
    return keep_one(df, keys, [rank.asc(), F.coalesce(F.col(confidence), F.lit(0.0)).desc(), F.col(order).desc()])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`new` over `old` by key; columns that only one side has are NULL on the other."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of `new` that are new or differ from `old` in one of `columns`, NULLs being equal."""
    o = old.select(*keys, F.struct(*columns).alias("_old"))
    j = new.join(o, list(keys), "left")
    differs = F.col("_old").isNull()
    for c in columns:
        differs = differs | ~F.col(c).eqNullSafe(F.col("_old")[c])
    return j.where(differs).drop("_old")


def fill_blanks(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`target` with its blank columns filled from `source`; present values stay."""
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns])
    j = target.join(s, list(keys), "left")
    return j.withColumns({c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.col(f"_s_{c}")) for c in columns}).drop(*[f"_s_{c}" for c in columns])


def replace_slice(df: DataFrame, path: str, column: str = "vertical") -> None:
    """Overwrite only the partitions of `column` that `df` has; readers see either all of a partition or none."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
