"""Micro-batch sinks: a stream of landed records drives the keyed operators."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.operators.core import upsert_provenance
from cadastra.operators.keyed import keep_one, upsert


def _versioned(spark, path: str, schema: str) -> tuple[DataFrame, int]:
    """The newest complete version of a table kept as numbered folders, and its number."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [int(s.getPath().getName()[1:]) for s in fs.listStatus(root) if s.getPath().getName().startswith("v") and fs.exists(hadoop.Path(s.getPath(), "_SUCCESS"))] if fs.exists(root) else []
    return (spark.read.schema(schema).parquet(os.path.join(path, f"v{max(done)}")), max(done)) if done else (spark.createDataFrame([], schema), -1)


def keyed_sink(path: str, schema: str, keys: Sequence[str], order: str):
    """foreachBatch function: the batch's last row per key over the table. A batch that is run again writes the same version."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old, version = _versioned(spark, path, schema)
        if version >= batch_id:
            return
        last = keep_one(batch, keys, [F.col(order).desc()])
        upsert(old, last, keys).write.mode("overwrite").parquet(os.path.join(path, f"v{batch_id}"))

    return write


PROVENANCE = "source_id string, natural_key string, payload_sha string, first_run long, last_run long"


def provenance_sink(path: str):
    """foreachBatch function: the content-addressed record log, the batch's number being the run."""

    def write(batch: DataFrame, batch_id: int) -> None:
        old, version = _versioned(batch.sparkSession, path, PROVENANCE)
        if version >= batch_id:
            return
        upsert_provenance(old, batch, batch_id).write.mode("overwrite").parquet(os.path.join(path, f"v{batch_id}"))

    return write


def deduplicated(stream: DataFrame, delay: str = "1 day", stamp: str = "loaded_at") -> DataFrame:
    """A stream of deliveries without repeats of one payload within `delay`."""
    s = stream.withColumn("payload_sha", F.sha2("payload", 256)).withWatermark(stamp, delay)
    return s.dropDuplicatesWithinWatermark(["source_id", "natural_key", "payload_sha"])
