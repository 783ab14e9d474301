"""Data-quality gates: all figures of a table in one aggregate."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.runtime import absent, absent_number


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, filled, total, fill_rate), NULL rate for an empty table."""
    kinds = dict((f.name, f.dataType) for f in df.schema.fields)
    missing = lambda c: absent_number(F.col(c)) if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else absent(F.col(c)) if isinstance(kinds[c], T.StringType) else F.col(c).isNull()
    one = df.agg(F.count("*").alias("total"), *[F.count_if(~missing(c)).alias(f"f_{c}") for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"f_{c}").alias("filled")) for c in columns])
    return one.select("total", F.inline(rows)).select("column_name", "filled", "total", (F.col("filled") / F.nullif(F.col("total"), F.lit(0))).alias("fill_rate"))


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    if gone := [c for c in columns if c not in df.columns]:
        raise ValueError(f"columns are missing: {gone}")


def require(df: DataFrame, *, min_rows: int = 0, fill: dict[str, float] | None = None, domains: dict[str, set[str]] | None = None, key: str | None = None, max_blank_keys: float = 0.01) -> dict[str, float]:
    """Check a table in one pass; raises ValueError naming each failed rule, returns the figures."""
    fill, domains = fill or {}, domains or {}
    aggs = [F.count("*").alias("rows"), *[F.avg((~absent(F.col(c).cast("string"))).cast("int")).alias(f"fill_{c}") for c in fill], *[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*v)).alias(f"odd_{c}") for c, v in domains.items()]]
    if key:
        aggs.append(F.avg(absent(F.col(key).cast("string")).cast("int")).alias("blank_keys"))
    got = df.agg(*aggs).first().asDict()
    bad = []
    if got["rows"] < min_rows:
        bad.append(f"{got['rows']} rows, at least {min_rows} expected")
    bad += [f"{c} is filled in {got[f'fill_{c}']:.3f}, at least {t} expected" for c, t in fill.items() if got[f"fill_{c}"] is not None and got[f"fill_{c}"] < t]
    bad += [f"{got[f'odd_{c}']} values of {c} are unknown" for c in domains if got[f"odd_{c}"]]
    if key and got["blank_keys"] is not None and got["blank_keys"] > max_blank_keys:
        bad.append(f"{got['blank_keys']:.3f} of keys are blank")
    if bad:
        raise ValueError("; ".join(bad))
    return got


def safe_identifier(name: str) -> str:
    if not re.fullmatch(r"[a-z_][a-z0-9_]*", name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """(value, n) by falling n, then value; NULL counts as a value."""
    out = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return out.orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(top) if top else out
