"""From staging rows to resolved accounts, locations and contacts, and overlays on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions import keys as K
from cadastra.functions.text import normalize_name
from cadastra.runtime import absent


def last_of(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row a key, the last in `order`; an aggregate, so repeats collapse before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def accounts(sites: DataFrame, spec: K.KeySpec = K.KeySpec(("ein",)), order: Column | None = None) -> DataFrame:
    """(account_key, vertical, account_type, legal_name, name_normalized, phone, size_metric, source_id, natural_key), one row a key: of rows that share a key the last counts."""
    rows = sites.withColumn("account_key", K.account_key(sites, spec))
    rows = rows.select("account_key", "vertical", "account_type", F.col("name_raw").alias("legal_name"), normalize_name(F.coalesce(F.nullif("name_normalized", F.lit("")), F.col("name_raw"))).alias("name_normalized"), F.when(~absent(F.col("phone_normalized")), F.col("phone_normalized")).alias("phone"), F.when(~F.isnan("size_value"), F.col("size_value")).alias("size_metric"), "source_id", "natural_key", "loaded_at")
    return last_of(rows, ["account_key"], order if order is not None else F.struct("loaded_at", "source_id", "natural_key")).drop("loaded_at")


def locations(sites: DataFrame, spec: K.KeySpec = K.KeySpec(("ein",))) -> DataFrame:
    """(location_key, account_key, location_name, latitude, longitude, natural_key), one row a key; a position counts only if both parts are there."""
    rows = sites.withColumn("account_key", K.account_key(sites, spec))
    rows = rows.withColumn("location_key", K.location_key(F.col("account_key"), F.col("address_line_1"), F.col("zip5"), discriminator=F.col("natural_key")))
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & ~F.isnan("latitude") & ~F.isnan("longitude")
    rows = rows.select("location_key", "account_key", F.col("name_raw").alias("location_name"), F.when(both, F.col("latitude")).alias("latitude"), F.when(both, F.col("longitude")).alias("longitude"), "source_id", "natural_key", "loaded_at")
    return last_of(rows, ["location_key"], F.struct("loaded_at", "source_id", "natural_key")).drop("loaded_at", "source_id")


def contacts(sites: DataFrame, spec: K.KeySpec = K.KeySpec(("ein",)), role: str = "primary_phone") -> DataFrame:
    """(contact_key, account_key, role, full_name, phone) of the rows with a phone, one row a key."""
    rows = sites.withColumn("account_key", K.account_key(sites, spec)).where(~absent(F.col("phone_normalized")))
    rows = rows.select(K.contact_key(F.col("account_key"), F.lit(role), F.col("name_raw")).alias("contact_key"), "account_key", F.lit(role).alias("role"), F.col("name_raw").alias("full_name"), F.col("phone_normalized").alias("phone"), "loaded_at", "source_id", "natural_key")
    return last_of(rows, ["contact_key"], F.struct("loaded_at", "source_id", "natural_key")).drop("loaded_at", "source_id", "natural_key")


def with_owner(children: DataFrame, owners: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column) -> DataFrame:
    """Children with their owner's columns; of owners that stand twice the last counts, children without one are left out."""
    return children.join(last_of(owners.select(*keys, *columns, order.alias("_o")), list(keys), F.col("_o")).drop("_o"), list(keys))


def overlaid(df: DataFrame, overlay: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column, always: bool = False) -> DataFrame:
    """`df` with `columns` from the first overlay row of its key: where its own are NULL, or `always`."""
    first = overlay.groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("_o"))
    j = df.join(first, list(keys), "left")
    take = lambda c: F.coalesce(F.col(f"_o.{c}"), F.col(c)) if always else F.coalesce(F.col(c), F.col(f"_o.{c}"))
    return j.withColumns({c: take(c) for c in columns}).drop("_o")


def uncovered(df: DataFrame, cover: DataFrame, keys: Sequence[str], good: Column, order: Column) -> DataFrame:
    """Rows whose key has no cover, or whose last cover row isn't `good`."""
    last = cover.groupBy(*keys).agg(F.max_by(good, order).alias("_g")).where("_g").drop("_g")
    return df.join(last, list(keys), "left_anti")
