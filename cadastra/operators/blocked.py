"""All pairs of blocks, compared by numpy: parts of blocks meet, not records."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.runtime import evenly

#: Records of a part of a block, and pairs and texts that are compared at once.
PART, PAIRS, TEXTS = 128, 100_000, 1_000

Similarity = Callable[[list[str], list[str], np.ndarray, np.ndarray], np.ndarray]


def _parts(df: DataFrame, blocks: list[str], side: str) -> DataFrame:
    """(block, level, side): the records of each block in parts of about PART."""
    named = F.array(*[F.struct(F.lit(i).alias("level"), F.col(c).alias("block")) for i, c in enumerate(blocks)])
    rows = df.select("key", "text", *blocks, F.inline(F.filter(named, lambda x: x["block"].isNotNull())))
    sizes = rows.groupBy("level", "block").agg(F.ceil(F.count("*") / PART).alias("parts"))
    cut = rows.join(sizes, ["level", "block"]).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    return cut.groupBy("level", "block", "part").agg(F.collect_list(F.struct("key", "text", *blocks)).alias(side)).drop("part")


def compared_pairs(left: DataFrame, right: DataFrame, blocks: list[str], similarity: Similarity) -> DataFrame:
    """(key_a, key_b, sim): every pair of records of (key, text, blocks) that share a block, once.

    `blocks` are the names of columns, in each of which equal values that aren't NULL are a block; a pair of several
    blocks is taken from the first. What meets in a join are parts of blocks, so a text is sent once a part, not once
    a pair; each pair is formed and compared, by the arrays' places, in one of many even tasks.
    """
    met = _parts(left, blocks, "a").join(_parts(right, blocks, "b"), ["level", "block"]).select("level", "a", "b")

    def flat(column: pa.ListArray) -> tuple[np.ndarray, dict]:
        s = column.flatten()
        return np.asarray(column.offsets) - column.offsets[0].as_py(), {c: s.field(c) for c in ("key", "text", *blocks)}

    def compared(levels, oa, a, ob, b):
        ca, cb = np.diff(oa), np.diff(ob)
        n = ca * cb
        starts = np.cumsum(n) - n
        row = np.repeat(np.arange(len(n)), n)
        k = np.arange(n.sum()) - starts[row]
        ia, ib = (oa[:-1] - oa[0])[row] + k // cb[row], (ob[:-1] - ob[0])[row] + k % cb[row]
        a, b = ({c: v.slice(o[0], o[-1] - o[0]) for c, v in x.items()} for x, o in ((a, oa), (b, ob)))
        keep = np.ones(len(ia), dtype=bool)
        for level, c in enumerate(blocks[:-1]):
            codes = pd.factorize(np.array(a[c].to_pylist() + b[c].to_pylist(), dtype=object))[0]
            x, y = codes[: len(a[c])][ia], codes[len(a[c]) :][ib]
            keep &= (levels[row] <= level) | (x != y) | (x < 0)
        ia, ib = ia[keep], ib[keep]
        sim = similarity(a["text"].to_pylist(), b["text"].to_pylist(), ia, ib)
        return pa.RecordBatch.from_arrays([a["key"].take(pa.array(ia)), b["key"].take(pa.array(ib)), pa.array(sim, pa.float64())], ["key_a", "key_b", "sim"])

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            levels, (oa, a), (ob, b) = np.asarray(batch.column("level")), flat(batch.column("a")), flat(batch.column("b"))
            first = 0
            while first < len(levels):
                last, pairs, texts = first, 0, 0
                while last < len(levels) and pairs < PAIRS and texts < TEXTS:
                    x, y = int(oa[last + 1] - oa[last]), int(ob[last + 1] - ob[last])
                    pairs, texts, last = pairs + x * y, texts + x + y, last + 1
                yield compared(levels[first:last], oa[first : last + 1], a, ob[first : last + 1], b)
                first = last

    return evenly(met).mapInArrow(run, "key_a string, key_b string, sim double")
