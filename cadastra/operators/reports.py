"""Run records and reports: one aggregate each, returned as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.runtime import absent


def run_log(events: DataFrame, run: str, status: str, at: str) -> DataFrame:
    """(run, status, started, ended) of an append-only log of (run, status, at): the latest status is current, equal stamps by status."""
    return events.groupBy(run).agg(F.max_by(status, F.struct(at, status)).alias("status"), F.min(at).alias("started"), F.max(at).alias("ended"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, nulls) with blank text counting as NULL, in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")).alias(c) for c in columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])))


def numeric_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, n, filled, mean, median) of a number, NaN being none."""
    v = F.when(~F.isnan(value), F.col(value))
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count(v).alias("filled"), F.round(F.avg(v), 4).alias("mean"), F.round(F.percentile(v, F.lit(0.5)), 4).alias("median"))


def all_failed(df: DataFrame, status: str, skipped: str = "skipped", error: str = "error") -> DataFrame:
    """(attempted, failed, exit_code): 1 only if rows were attempted and every one ended in an error."""
    tried = F.coalesce(F.col(status) != skipped, F.lit(True))
    wrong = F.coalesce(F.col(status) == error, F.lit(False))
    one = df.agg(F.count_if(tried).alias("attempted"), F.count_if(tried & wrong).alias("failed"))
    return one.select("*", F.when((F.col("attempted") > 0) & (F.col("attempted") == F.col("failed")), 1).otherwise(0).alias("exit_code"))


def shares(df: DataFrame, method: str, fallback: str) -> DataFrame:
    """(method, n, share, warning): how rows were settled; NULL is unresolved, and a fallback of more than half is worth a warning."""
    counts = df.groupBy(F.coalesce(F.col(method), F.lit("unresolved")).alias("method")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    out = counts.withColumn("share", F.round(F.col("n") / total.select("t").scalar(), 6))
    return out.withColumn("warning", (F.col("method") == "unresolved") | ((F.col("method") == fallback) & (F.col("share") > 0.5)))


def manifest(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(by, entries, manifest): the group's rows as a sorted JSON list; `by` should name groups of a bounded size, as one source's files."""
    return df.groupBy(by).agg(F.count("*").alias("entries"), F.to_json(F.array_sort(F.collect_set(F.struct(*columns)))).alias("manifest"))


def raw_digest(columns: Sequence[str], geometry: str) -> Column:
    """sha256 of a row's JSON in which the geometry is its own hash, so that large shapes don't have to be kept to compare deliveries."""
    return F.sha2(F.to_json(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns], F.sha2(F.coalesce(F.col(geometry), F.lit("")), 256).alias("geometry_sha"))), 256)


def present_share(c: Column) -> Column:
    return F.avg(F.when(absent(c), 0.0).otherwise(1.0))


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV files with headers, NULL as an empty field."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def write_rollup(df: DataFrame, path: str, key: str) -> None:
    """Replace a rollup as a whole, rows without a key left out."""
    df.where(F.col(key).isNotNull()).write.mode("overwrite").parquet(path)
