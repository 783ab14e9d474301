"""Served tables: insert, update and tombstone against the resolved set; provenance; review pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.keys import content_hash


def diff_actions(resolved: DataFrame, core: DataFrame, key: str, hashed: Sequence[Column | str], gone: str = "tombstone", gone_filter: Column | None = None) -> DataFrame:
    """(key, action): insert if only resolved has the key, update if the contents' hashes differ, `gone` if only core has it.

    Unchanged keys yield nothing, so a second run on the same input is empty. `gone_filter` is over core's columns.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in hashed]
    r = resolved.select(F.col(key), content_hash(cols).alias("_new"))
    c = core.select(F.col(key), content_hash(cols).alias("_old"), (gone_filter if gone_filter is not None else F.lit(True)).alias("_may"))
    both = r.join(c, key, "full")
    action = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), F.when(F.col("_may"), gone)).when(F.col("_new") != F.col("_old"), "update")
    return both.select(key, action.alias("action")).where(F.col("action").isNotNull())


def apply_diff(resolved: DataFrame, core: DataFrame, actions: DataFrame, key: str, columns: Sequence[str], status: str | None = "status", gone_value: str = "merged") -> DataFrame:
    """The next core: inserted and updated rows from resolved, tombstoned ones kept with `status` set, the rest as they are."""
    new = resolved.join(actions.where("action IN ('insert', 'update')").select(key), key, "left_semi").select(key, *columns)
    marked = core.join(actions.where("action NOT IN ('insert', 'update')").select(key), key, "left_semi").select(key, *columns)
    if status:
        marked = marked.withColumn(status, F.lit(gone_value))
    kept = core.join(actions.select(key), key, "left_anti").select(key, *columns)
    return kept.unionByName(new).unionByName(marked)


def contact_actions(resolved: DataFrame, core: DataFrame, accounts: DataFrame, hashed: Sequence[str], key: str = "contact_key") -> DataFrame:
    """(key, action): insert only where the account is served, update where the content differs, retire the current ones that are gone."""
    known = resolved.join(accounts.select("account_key").distinct(), "account_key", "left_semi")
    old = core.select(key).distinct()
    new = known.join(old, key, "left_anti").select(key, F.lit("insert").alias("action"))
    # an update needs no account, the row is served already
    both = diff_actions(resolved.join(old, key, "left_semi"), core, key, hashed, gone="retire", gone_filter=F.col("is_current"))
    return new.unionByName(both)


def stale_locations(resolved: DataFrame, core: DataFrame, accounts: DataFrame, gone_value: str = "merged") -> DataFrame:
    """(location_key) of served locations that are gone and whose account is tombstoned; others only grow old."""
    gone = core.where("location_key IS NOT NULL").join(resolved.select("location_key").distinct(), "location_key", "left_anti")
    return gone.join(accounts.where(F.col("status") == gone_value).select("account_key").distinct(), "account_key", "left_semi").select("location_key")


def updated_status(resolved: DataFrame, core: DataFrame, key: str = "account_key", gone_value: str = "merged") -> DataFrame:
    """(key, status) after an update: a tombstoned row is never resurrected."""
    j = resolved.select(key, F.col("status").alias("_new")).join(core.select(key, F.col("status").alias("_old")), key)
    return j.select(key, F.when(F.col("_old") == gone_value, F.lit(gone_value)).otherwise(F.col("_new")).alias("status"))


def with_parent(df: DataFrame, core: DataFrame, key: str = "account_key", parent: str = "parent_account_key") -> DataFrame:
    """(key, parent, known): each row's parent and whether the parent is served; the survivor of a tombstone is its parent."""
    served = core.select(F.col(key).alias(parent)).distinct().withColumn("known", F.lit(True))
    return df.select(key, parent).join(served, parent, "left").select(key, parent, F.coalesce("known", F.lit(False)).alias("known"))


def upsert_provenance(old: DataFrame, batch: DataFrame, run_id: int) -> DataFrame:
    """Content-addressed records (source_id, natural_key, payload_sha, first_run, last_run): a known payload moves its last run, a new one enters."""
    keys = ["source_id", "natural_key", "payload_sha"]
    now = batch.select("source_id", "natural_key", F.sha2("payload", 256).alias("payload_sha")).distinct().withColumn("_now", F.lit(True))
    j = old.join(now, keys, "full")
    return j.select(*keys, F.coalesce("first_run", F.lit(run_id)).cast("long").alias("first_run"), F.when(F.col("_now"), F.lit(run_id)).otherwise(F.col("last_run")).cast("long").alias("last_run"))


def upsert_review_pairs(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Review pairs in one order of their two records, per strategy: scores are renewed, merged and rejected ones never demoted."""
    def ordered(df: DataFrame) -> DataFrame:
        a, b = F.struct("source_id_a", "natural_key_a"), F.struct("source_id_b", "natural_key_b")
        flip = a > b
        pick = lambda x, y: F.when(flip, F.col(y)).otherwise(F.col(x))
        return df.withColumns({"source_id_a": pick("source_id_a", "source_id_b"), "natural_key_a": pick("natural_key_a", "natural_key_b"), "source_id_b": pick("source_id_b", "source_id_a"), "natural_key_b": pick("natural_key_b", "natural_key_a")})

    keys = ["source_id_a", "natural_key_a", "source_id_b", "natural_key_b", "merge_strategy"]
    one = ordered(batch).groupBy(*keys).agg(F.min_by("score", "ord").alias("new_score"))
    known = ordered(old).groupBy(*keys).agg(F.max_by(F.struct("score", "status"), "ord").alias("o"))
    j = known.join(one, keys, "full")
    settled = F.col("o.status").isin("merged", "rejected")
    return j.select(*keys, F.when(settled | F.col("new_score").isNull(), F.col("o.score")).otherwise(F.col("new_score")).alias("score"), F.coalesce("o.status", F.lit("pending")).alias("status"))
