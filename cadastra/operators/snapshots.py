"""What changed between full snapshots.

Snapshots are sorted by key inside hash shards and cut into content-defined chunks: a row whose
key hashes to 0 modulo the chunk length opens a chunk, so an insertion or removal never moves
the cuts of other chunks. Chunks with equal digests in two consecutive deliveries are discarded;
only the rows of unmatched chunks are joined and classified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.runtime import absent, absent_number, latest_rows, materialize

CHUNK_ROWS = 64
SEED_TEXT = "\x01"


def _json_text(c: Column) -> Column:
    """A JSON object's non-null members in name order; anything that is no object as it stands."""
    members = F.array_sort(F.map_entries(F.map_filter(F.from_json(c, "map<string,string>"), lambda _, v: v.isNotNull())))
    return F.when(F.trim(c).startswith("{"), F.coalesce(F.to_json(members), c)).otherwise(c)


def _canonical(field: T.StructField, json_columns: set[str]) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.when(~absent_number(c), (F.round(c.cast("double"), 6) + F.lit(0.0)).cast("string"))
    if isinstance(field.dataType, T.StringType):
        return F.when(~absent(c), _json_text(c) if field.name in json_columns else c)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    return c.cast("string")


def content_digest(df: DataFrame, ignore: set[str], json_columns: set[str]) -> Column:
    """64 bits over all columns but `ignore`; NULL takes a mark of its own, so values can't shift between columns."""
    parts = [F.coalesce(_canonical(f, json_columns), F.lit("\x00")) for f in sorted(df.schema.fields, key=lambda f: f.name) if f.name not in ignore]
    return F.xxhash64(F.concat_ws(SEED_TEXT, *parts)) if parts else F.lit(0).cast("long")


def keyed_digests(df: DataFrame, key: str, snapshot: str, group: str, stamp: str, snapshot_meta: list[str], json_columns: list[str], shards: int) -> DataFrame:
    """(shard, grp, snapshot_no, record_key, digest): the current row of every key and snapshot as one number."""
    ignore = {snapshot, stamp, key, *snapshot_meta}
    slim = df.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull()).select(
        F.pmod(F.xxhash64(F.col(key)), F.lit(shards)).cast("int").alias("shard"),
        F.coalesce(F.col(group), F.lit("\x00")).alias("grp"),
        F.col(snapshot).cast("int").alias("snapshot_no"),
        F.col(key).alias("record_key"),
        content_digest(df, ignore, set(json_columns)).alias("digest"),
        F.col(stamp).alias("stamp"),
    )
    # one shuffle on the shard; the aggregate below and every window after it stay in place
    return latest_rows(slim.repartition(F.col("shard")), ["shard", "snapshot_no", "record_key"], "stamp").drop("stamp")


def _chunked(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """Adds chunk: the key that opened the row's chunk, '' before the first such key of the shard."""
    opens = F.when(F.pmod(F.xxhash64(F.col("record_key"), F.lit(7)), F.lit(chunk_rows)) == 0, F.col("record_key"))
    w = Window.partitionBy("shard", "grp", "snapshot_no").orderBy("record_key").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("chunk", F.coalesce(F.last(opens, ignorenulls=True).over(w), F.lit("")))


def _chunk_digests(chunked: DataFrame) -> DataFrame:
    mixed = F.xxhash64(F.col("record_key"), F.col("digest"))
    return chunked.groupBy("shard", "grp", "snapshot_no", "chunk").agg(
        F.struct(
            F.count("*").alias("n"),
            F.bit_xor(mixed).alias("x"),
            F.sum(F.shiftright(F.xxhash64(mixed, F.lit(11)), 20)).alias("s"),
        ).alias("chunk_digest")
    )


def changed_records(
    df: DataFrame,
    key: str,
    *,
    snapshot: str = "snapshot_no",
    group: str = "vertical",
    stamp: str = "loaded_at",
    snapshot_meta: tuple[str, ...] = ("snapshot_date",),
    json_columns: tuple[str, ...] = (),
    chunk_rows: int = CHUNK_ROWS,
    shards: int | None = None,
) -> DataFrame:
    """(record_key, snapshot_no, change_kind) of each consecutive pair of deliveries of a group.

    Within a snapshot the row with the latest `stamp` counts. A group without a row in a snapshot
    was not delivered; its next delivery is compared with its last one, the first yields nothing.
    Absent values (NULL, blank, nan, NaN) are equal, doubles compare to 6 decimals, `json_columns`
    by their non-null members. Rows with a NULL key or snapshot number are no records and yield
    nothing; repeated rows count once; an empty table gives an empty result; further columns take
    part in the comparison under whatever name.
    """
    spark = df.sparkSession
    shards = shards or max(64, 16 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = keyed_digests(df, key, snapshot, group, stamp, list(snapshot_meta), list(json_columns), shards)
    # written once: key, digest and chunk of every row feed the chunk digests and the final join
    chunked = materialize(_chunked(rows, chunk_rows), "snapshots")
    digests = _chunk_digests(chunked)

    # deliveries: one row per group and snapshot, a handful; aggregated partially before it moves
    delivered = digests.select("grp", "snapshot_no").distinct()
    order = Window.partitionBy("grp").orderBy("snapshot_no")
    steps = delivered.select("grp", "snapshot_no", F.lag("snapshot_no").over(order).alias("before"), F.lead("snapshot_no").over(order).alias("after"))

    # a chunk is matched if the same stretch of keys has the same digest in the other delivery
    told = digests.join(steps, ["grp", "snapshot_no"])
    by_stretch = Window.partitionBy("shard", "grp", "chunk").orderBy("snapshot_no")
    same_before = (F.lag("snapshot_no").over(by_stretch) == F.col("before")) & (F.lag("chunk_digest").over(by_stretch) == F.col("chunk_digest"))
    same_after = (F.lead("snapshot_no").over(by_stretch) == F.col("after")) & (F.lead("chunk_digest").over(by_stretch) == F.col("chunk_digest"))
    unmatched = (
        told.select(
            "shard", "grp", "snapshot_no", "chunk",
            F.when(F.col("before").isNotNull() & ~F.coalesce(same_before, F.lit(False)), F.col("snapshot_no")).alias("as_new"),
            F.when(F.col("after").isNotNull() & ~F.coalesce(same_after, F.lit(False)), F.col("after")).alias("as_old"),
        )
        .where(F.col("as_new").isNotNull() | F.col("as_old").isNotNull())
    )

    left = chunked.join(unmatched, ["shard", "grp", "snapshot_no", "chunk"])
    sides = left.select(
        "record_key", "grp", "digest",
        F.explode(F.array(F.struct(F.col("as_new").alias("at"), F.lit(True).alias("new")), F.struct(F.col("as_old").alias("at"), F.lit(False).alias("new")))).alias("side"),
    ).where(F.col("side.at").isNotNull())
    both = sides.groupBy("grp", F.col("side.at").alias("snapshot_no"), "record_key").agg(
        F.max(F.when(F.col("side.new"), F.col("digest"))).alias("now"),
        F.max(F.when(~F.col("side.new"), F.col("digest"))).alias("was"),
    )
    kind = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("now") != F.col("was"), "changed")
    return both.select("record_key", "snapshot_no", kind.alias("change_kind")).where(F.col("change_kind").isNotNull())
