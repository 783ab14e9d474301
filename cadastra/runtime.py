"""Session helpers: table access, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest relation, in bytes of its files or its plan's estimate, that may be broadcast by hand.
BROADCAST_LIMIT = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Unset, a temporary one in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    made = "file://" + tempfile.mkdtemp(prefix="cadastra_")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def materialize(df: DataFrame, tag: str = "step") -> DataFrame:
    """Cut the lineage: write `df` once to the shared folder and read it back.

    The files outlive executors, are columnar and compressed, and carry sizes from which the
    optimizer picks join strategies. Every call writes to a folder of its own.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/cadastra/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cadastra_path = path
    _MADE.append(path)
    return out


_MADE: list[str] = []


def forget(spark: SparkSession) -> int:
    """Delete every folder that materialize() made and nobody discarded, once the results that read them are written."""
    n = len(_MADE)
    while _MADE:
        _delete(spark, _MADE.pop())
    return n


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Delete the files behind a frame made by materialize(); nothing may read it afterwards."""
    path = getattr(df, "_cadastra_path", None)
    if path:
        _delete(df.sparkSession, path)
        if path in _MADE:
            _MADE.remove(path)


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores, if it has fewer partitions than there are: a small table in one file is one task else."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def evenly(df: DataFrame) -> DataFrame:
    """`df` over all shuffle partitions: for short rows that cost much CPU, whose partitions would be merged by their bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of `df` in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only if the optimizer's estimate is within `limit`; else leave the choice to Spark."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df


def absent(c: Column) -> Column:
    """True for NULL, blank text and the text nan. For numbers use absent_number."""
    return c.isNull() | F.lower(F.trim(c)).isin("", "nan")


def absent_number(c: Column) -> Column:
    return c.isNull() | F.isnan(c)


def present_or_null(c: Column) -> Column:
    """The text itself, or NULL if it is absent."""
    return F.when(~absent(c), c)


def record_key(source: str = "source_id", key: str = "natural_key") -> Column:
    return F.concat(F.col(source), F.lit(":"), F.col(key))


def latest_rows(df: DataFrame, keys: list[str], order: str = "loaded_at", columns: list[str] | None = None) -> DataFrame:
    """One row per key: the one with the latest `order`; equal stamps are settled by the values.

    An aggregate, not a window, so repeats collapse before the shuffle and no key needs a sort.
    Rows with a NULL key are dropped: they have no key to be current for. A NULL stamp is oldest.
    """
    rest = [c for c in (columns or df.columns) if c not in keys and c != order]
    pick = F.max_by(F.struct(*[F.col(c) for c in [order, *rest]]), F.struct(F.col(order), F.hash(*rest) if rest else F.lit(0)))
    kept = df.where(~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    return kept.groupBy(*keys).agg(pick.alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in [order, *rest]])
