"""Deterministic keys and content hashes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.text import normalize_name, normalize_zip
from cadastra.runtime import absent


@dataclass(frozen=True)
class KeySpec:
    """Identifiers an account key is taken from, first present first, and whether name parts are normalized."""

    priority: tuple[str, ...] = ("ccn", "npi", "geoid", "leaid", "ein", "sunbiz_doc", "trec_assoc_id", "license_no")
    normalize_parts: bool = True


def _key(c: Column) -> Column:
    return F.sha2(c, 256)


def account_key(df: DataFrame, spec: KeySpec = KeySpec(), name: str = "name_normalized", raw_name: str = "name_raw", zip5: str = "zip5") -> Column:
    """sha256 of 'field:value' of the first present identifier that `df` has, else of name and zip."""
    n = F.coalesce(F.nullif(F.col(name), F.lit("")), F.col(raw_name), F.lit(""))
    z = F.coalesce(F.col(zip5), F.lit(""))
    n, z = (normalize_name(n), normalize_zip(z)) if spec.normalize_parts else (n, z)
    out = F.concat(F.lit("name:"), n, F.lit("|zip:"), z)
    for field in reversed([f for f in spec.priority if f in df.columns]):
        out = F.when(~absent(F.col(field)), F.concat(F.lit(f"{field}:"), F.trim(F.col(field)))).otherwise(out)
    return _key(out)


def location_key(account: Column, address: Column, zip5: Column, normalize_parts: bool = True, discriminator: Column | None = None) -> Column:
    a, z = F.coalesce(address, F.lit("")), F.coalesce(zip5, F.lit(""))
    a, z = (normalize_name(a), normalize_zip(z)) if normalize_parts else (a, z)
    tail = [] if discriminator is None else [F.lit("|"), discriminator]
    return _key(F.concat(F.lit("loc:"), account, F.lit("|"), a, F.lit("|"), z, *tail))


def contact_key(account: Column, role: Column, name: Column, normalize_parts: bool = True) -> Column:
    n = F.coalesce(name, F.lit(""))
    return _key(F.concat(F.lit("contact:"), account, F.lit("|"), role, F.lit("|"), normalize_name(n) if normalize_parts else n))


def content_hash(columns: Sequence[Column]) -> Column:
    """md5 of the columns' texts joined by |, NULLs left out (so values may shift between neighbours)."""
    return F.md5(F.concat_ws("|", *columns))
