"""Filling fixed-capacity containers: best-fit decreasing per partition, certified by lower bounds, gaps repacked."""

from __future__ import annotations

from bisect import bisect_left, insort
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.runtime import materialize

#: Items a partition packs at once; a partition's memory is bounded by it.
PARTITION_ITEMS = 20_000


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item; each goes to the fullest bin that still takes it."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), dtype=np.int64)
    rooms: list[int] = []  # distinct free rooms, ascending
    by_room: dict[int, list[int]] = {}
    n = 0
    for i in order.tolist():
        size = int(sizes[i])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
        else:
            b, room = n, capacity
            n += 1
        bins[i] = b
        left = room - size
        if left in by_room:
            by_room[left].append(b)
        else:
            by_room[left] = [b]
            insort(rooms, left)
    return bins


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Least number of bins that any packing needs, by dual feasible functions.

    The identity gives the volume bound. The threshold family sends sizes above capacity - k to a whole bin, those
    below k to nothing and keeps the rest; the rounding family sends x to floor((k + 1) x) / k unless (k + 1) x is whole.
    """
    s = np.sort(sizes[sizes > 0].astype(np.int64))
    if len(s) == 0:
        return int(len(sizes) > 0)
    total = np.concatenate([[0], np.cumsum(s)])
    best = -(-int(total[-1]) // capacity)
    ks = np.unique(s[s <= capacity // 2])
    if len(ks):
        big = len(s) - np.searchsorted(s, capacity - ks, side="right")
        kept = total[np.searchsorted(s, capacity - ks, side="right")] - total[np.searchsorted(s, ks, side="left")]
        best = max(best, int(np.max(big + -(-kept // capacity))))
    best = max(best, int(np.count_nonzero(2 * s > capacity)))
    for k in range(1, 21):
        scaled = (k + 1) * s
        whole = scaled % capacity == 0
        # in k-ths of a bin times (k + 1), whole numbers throughout
        value = np.where(whole, scaled // capacity * k, scaled // capacity * (k + 1))
        best = max(best, -(-int(value.sum()) // (k * (k + 1))))
    return best


ITEM = "container_kind string, capacity long, doc_id long, piece_no long, token_start long, n_tokens long"
PACKED = ITEM + ", part int, container_id string, reopen boolean, bound long"


def _packer(r: int, last: bool):
    """Packs one partition of a kind and marks the bins to open again."""

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        capacity = int(frame["capacity"].iloc[0])
        frame = frame.sort_values(["n_tokens", "doc_id", "piece_no"], kind="stable", ignore_index=True)
        size = frame["n_tokens"].to_numpy(dtype=np.int64)
        bins = best_fit_decreasing(size, capacity)
        used, bound = int(bins.max()) + 1, lower_bound(size, capacity)
        reopen = np.zeros(used, dtype=bool)
        if not last and used > bound:
            # the emptiest bins: enough room to save the excess, at least a tenth of all
            fill = np.bincount(bins, weights=size, minlength=used)
            reopen[np.argsort(fill, kind="stable")[: max(8 * (used - bound), used // 10, 2)]] = True
        frame["container_id"] = [f"{r}-{key[1]}-{b}" for b in bins]
        frame["reopen"] = reopen[bins]
        frame["bound"] = bound
        return frame

    return pack


def packed(sizes: DataFrame, spec: DataFrame, **options) -> DataFrame:
    """The containers of packing(), see there."""
    return packing(sizes, spec, **options)[0]


def packing(sizes: DataFrame, spec: DataFrame, *, partition_items: int = PARTITION_ITEMS, rounds: int = 4) -> tuple[DataFrame, DataFrame]:
    """(containers, certificate). Containers of every kind of `spec` (container_kind, capacity_tokens) filled with the items of `sizes` (doc_id, n_tokens).

    Returns (container_kind, container_id, doc_id, piece_no, token_start, n_tokens): one row per item and kind, or
    one per piece of an item above the capacity, which alone is divided: into full containers and one rest. Items
    without tokens take no room and stand in some container. Kinds with a NULL or non-positive capacity hold
    nothing; a kind named twice has its larger capacity; a NULL size is 0. No item gives an empty result.

    Items are spread over partitions by hash, so none depends on how the input was laid out. Each partition is packed by
    best-fit decreasing and its bins are counted against a lower bound; where bound and count agree it is done. The
    emptiest bins of the others are opened again, their items dealt anew over fewer partitions, and packed again, for
    `rounds` rounds; the other bins are never touched again.

    The certificate is (container_kind, round, part, items, bins, bound, reopened): for every partition of every round the
    bins it used, the least number that any packing of its items needs, and the bins that it gave on to the next round.
    Round -1 holds the full containers, which are their own bound. A partition with bins = bound is packed optimally.
    """
    kinds = spec.where("capacity_tokens > 0 AND container_kind IS NOT NULL").groupBy("container_kind").agg(F.max("capacity_tokens").cast("long").alias("capacity"))
    n = F.greatest(F.coalesce(F.col("n_tokens"), F.lit(0)), F.lit(0)).cast("long")
    items = sizes.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n"))
    # each item goes to each kind: the kinds are one value, a list
    spread = items.withColumn("_kinds", kinds.agg(F.collect_list(F.struct("container_kind", "capacity"))).scalar()).select("doc_id", "n", F.inline("_kinds"))
    full = F.floor(F.col("n") / F.col("capacity"))
    rest = F.col("n") - full * F.col("capacity")
    pieces = F.sequence(F.lit(0).cast("long"), F.when((rest > 0) | (full == 0), full).otherwise(full - 1))
    item = spread.select("container_kind", "capacity", "doc_id", "n", F.explode(pieces).alias("piece_no"))
    start = F.col("piece_no") * F.col("capacity")
    item = item.select("container_kind", "capacity", "doc_id", "piece_no", start.alias("token_start"), F.least(F.col("capacity"), F.col("n") - start).alias("n_tokens"))
    item = materialize(item, "items")

    whole = item.where("n_tokens = capacity").withColumn("container_id", F.concat_ws("-", F.lit("full"), "doc_id", "piece_no"))
    open_items = item.where("n_tokens < capacity")
    done = [whole.drop("capacity")]
    proofs = [whole.groupBy("container_kind").agg(F.count("*").alias("items")).select("container_kind", F.lit(-1).alias("round"), F.lit(0).alias("part"), "items", F.col("items").alias("bins"), F.col("items").alias("bound"), F.lit(0).cast("long").alias("reopened"))]
    for r in range(rounds):
        # one row per kind: how many partitions its items need
        counts = open_items.groupBy("container_kind").agg(F.ceil(F.count("*") / partition_items).cast("int").alias("parts"))
        dealt = open_items.join(counts, "container_kind").withColumn("part", F.pmod(F.xxhash64("doc_id", "piece_no", F.lit(r)), F.col("parts")).cast("int")).drop("parts")
        last = r == rounds - 1

        out = materialize(dealt.groupBy("container_kind", "part").applyInPandas(_packer(r, last), PACKED), "packed")
        bins = out.groupBy("container_kind", "part", "container_id").agg(F.count("*").alias("n"), F.max("bound").alias("bound"), F.max("reopen").alias("reopen"))
        proofs.append(bins.groupBy("container_kind", "part").agg(F.sum("n").alias("items"), F.count("*").alias("bins"), F.max("bound").alias("bound"), F.count_if("reopen").alias("reopened")).select("container_kind", F.lit(r).alias("round"), "part", "items", "bins", "bound", "reopened"))
        done.append(out.where("NOT reopen").drop("capacity", "reopen", "part", "bound"))
        open_items = out.where("reopen").drop("container_id", "reopen", "part", "bound")
        if last or open_items.isEmpty():
            break
    columns = ["container_kind", "container_id", "doc_id", "piece_no", "token_start", "n_tokens"]
    return reduce(DataFrame.unionByName, done).select(*columns), reduce(DataFrame.unionByName, proofs)
