"""Polygon kit: boxes, areas, intersections, overlap joins over GeoJSON."""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions.geo import polygons
from cadastra.functions.similarity import name_similarity
from cadastra.operators.linkage import components
from cadastra.runtime import absent, materialize


def box(geojson: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) of a Polygon or MultiPolygon."""
    points = F.flatten(F.flatten(polygons(geojson)))
    x, y = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(F.array_min(x).alias("xmin"), F.array_min(y).alias("ymin"), F.array_max(x).alias("xmax"), F.array_max(y).alias("ymax"))


def box_center(b: Column) -> Column:
    return F.struct(((b["xmin"] + b["xmax"]) / 2).alias("lon"), ((b["ymin"] + b["ymax"]) / 2).alias("lat"))


def ring_area(ring: Column) -> Column:
    """Signed area of a closed ring of [x, y], counter-clockwise positive."""
    n = F.size(ring)
    term = lambda i: ring[i][0] * ring[F.pmod(i + 1, n)][1] - ring[F.pmod(i + 1, n)][0] * ring[i][1]
    return F.when(n >= 3, F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda s, i: s + term(i)) / 2)


def planar_area(geojson: Column) -> Column:
    """Square degrees of all polygons, holes taken off."""
    whole = lambda rings: 2 * F.abs(ring_area(rings[0])) - F.aggregate(F.transform(rings, lambda r: F.abs(ring_area(r))), F.lit(0.0), lambda s, a: s + a)
    return F.aggregate(F.transform(polygons(geojson), whole), F.lit(0.0), lambda s, a: s + a)


def is_box(geojson: Column) -> Column:
    """True for one polygon of one closed ring of four corners, its sides along the axes in turn: it fills its box."""
    parts = polygons(geojson)
    ring = parts[0][0]
    same = lambda i, j, k: ring[i][k] == ring[j][k]
    sides = (same(0, 1, 0) & same(1, 2, 1) & same(2, 3, 0) & same(3, 0, 1)) | (same(0, 1, 1) & same(1, 2, 0) & same(2, 3, 1) & same(3, 0, 0))
    return F.coalesce(F.when((F.size(parts) == 1) & (F.size(parts[0]) == 1) & (F.size(ring) == 5), sides & same(0, 4, 0) & same(0, 4, 1)), F.lit(False))


def _edges(text: str | None) -> np.ndarray | None:
    if not text:
        return None
    try:
        g = json.loads(text)
        polys = [g["coordinates"]] if g.get("type") == "Polygon" else g["coordinates"] if g.get("type") == "MultiPolygon" else None
        if not polys:
            return None
        out = []
        for ring in (r for p in polys for r in p):
            p = np.asarray([q[:2] for q in ring], dtype=float)
            out.append(np.hstack([p, np.roll(p, -1, axis=0)]))
        return np.vstack(out)
    except (ValueError, KeyError, TypeError):
        return None


def _spans(edges: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """x positions where horizontal lines cross a shape, sorted, one array per y."""
    x1, y1, x2, y2 = edges.T
    hit = ((y1[None, :] > y[:, None]) != (y2[None, :] > y[:, None]))
    with np.errstate(divide="ignore", invalid="ignore"):
        x = x1 + (y[:, None] - y1) / (y2 - y1) * (x2 - x1)
    return [np.sort(x[i, hit[i]]) for i in range(len(y))]


def _crossing_heights(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d1, d2 = a[:, 2:] - a[:, :2], b[:, 2:] - b[:, :2]
    den = d1[:, None, 0] * d2[None, :, 1] - d1[:, None, 1] * d2[None, :, 0]
    off = b[None, :, :2] - a[:, None, :2]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (off[..., 0] * d2[None, :, 1] - off[..., 1] * d2[None, :, 0]) / den
        u = (off[..., 0] * d1[:, None, 1] - off[..., 1] * d1[:, None, 0]) / den
        ok = (den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        return (a[:, None, 1] + t * d1[:, None, 1])[ok]


def intersection_area(a: np.ndarray, b: np.ndarray) -> float:
    """Area common to two even-odd shapes of straight edges: between the heights of all corners and crossings every
    width is linear, so the width in the middle of each slab is exact."""
    lo, hi = max(a[:, 1].min(), b[:, 1].min()), min(a[:, 1].max(), b[:, 1].max())
    if lo >= hi:
        return 0.0
    ys = np.concatenate([a[:, 1], b[:, 1], _crossing_heights(a, b), [lo, hi]])
    ys = np.unique(ys[(ys >= lo) & (ys <= hi)])
    mid = (ys[1:] + ys[:-1]) / 2
    total = 0.0
    for h, p, q in zip(np.diff(ys), _spans(a, mid), _spans(b, mid)):
        for i in range(0, len(p) - 1, 2):
            for j in range(0, len(q) - 1, 2):
                total += h * max(0.0, min(p[i + 1], q[j + 1]) - max(p[i], q[j]))
    return float(total)


@F.pandas_udf(T.DoubleType())
def common_area(a: pd.Series, b: pd.Series) -> pd.Series:
    """Square degrees common to two GeoJSON shapes; NULL if either is none."""
    known: dict[str, np.ndarray | None] = {}

    def edges(t):
        if t not in known:
            known[t] = _edges(t)
        return known[t]

    out = []
    for x, y in zip(a, b):
        p, q = edges(x), edges(y)
        out.append(None if p is None or q is None else intersection_area(p, q))
    return pd.Series(out, dtype="float64")


def overlap_pairs(left: DataFrame, right: DataFrame, *, cell: float = 0.5, same: bool = False, over: float | None = None) -> DataFrame:
    """(a, b, common, iou) of intersecting shapes of (key, geojson): boxes meet in a grid cell, then exact areas.

    A pair is formed only in the cell of its boxes' common south-west corner, so it is compared once. With
    `same`, left and right are one table and a < b. Areas of both and the common one give the union without building it.
    With `over`, only pairs of a larger IoU: no more than the boxes' common part can be common, so the others are dropped
    before their shapes are fetched; of two shapes that fill their boxes it is the common part. The cells hold numbers only, and are sorted and merged, never broadcast: the optimizer
    takes a box for one row, however many cells it covers.
    """
    def shapes(df: DataFrame) -> DataFrame:
        g = F.col("geojson")
        t = df.select("key", "geojson", box(g).alias("box"), is_box(g).alias("filled")).where("box.xmin IS NOT NULL")
        t = t.withColumn("area", F.when(F.col("filled"), F.expr("(box.xmax - box.xmin) * (box.ymax - box.ymin)")).otherwise(planar_area(g)))
        return materialize(t.withColumn("row", F.monotonically_increasing_id()), "shapes")

    def boxed(df: DataFrame, p: str) -> DataFrame:
        t = df.select(F.col("row").alias(p + "_row"), F.col("key").alias(p), F.col("box").alias(p + "_b"), F.col("filled").alias(p + "_filled"), F.col("area").alias(p + "_area"))
        b = F.col(p + "_b")
        return t.withColumn("cy", F.explode(F.sequence(F.floor(b["ymin"] / cell), F.floor(b["ymax"] / cell)))).withColumn("cx", F.explode(F.sequence(F.floor(b["xmin"] / cell), F.floor(b["xmax"] / cell))))

    lefts = shapes(left)
    rights = lefts if same else shapes(right)
    j = boxed(lefts, "a").join(boxed(rights, "b").hint("merge"), ["cy", "cx"])
    a, b = F.col("a_b"), F.col("b_b")
    west, south = F.greatest(a["xmin"], b["xmin"]), F.greatest(a["ymin"], b["ymin"])
    east, north = F.least(a["xmax"], b["xmax"]), F.least(a["ymax"], b["ymax"])
    meet = (west < east) & (south < north) & (F.floor(west / cell) == F.col("cx")) & (F.floor(south / cell) == F.col("cy"))
    j = j.where(meet & (F.col("a") < F.col("b") if same else F.lit(True)))
    j = j.withColumn("most", (east - west) * (north - south))
    if over is not None:
        j = j.where(F.col("most") * (1 + over) > (F.col("a_area") + F.col("b_area")) * (over * (1 - 1e-6)))
    met = materialize(j.select("a", "b", "a_row", "b_row", "a_area", "b_area", "most", (F.col("a_filled") & F.col("b_filled")).alias("filled")), "met")
    side = lambda df, p: df.select(F.col("row").alias(p + "_row"), F.col("geojson").alias(p + "_g"))
    odd = met.where("NOT filled").join(side(lefts, "a"), "a_row").join(side(rights, "b"), "b_row").withColumn("common", common_area(F.col("a_g"), F.col("b_g")))
    cols = ["a", "b", "a_area", "b_area", "common"]
    t = met.where("filled").withColumn("common", F.col("most")).select(*cols).unionByName(odd.select(*cols)).where("common > 0")
    t = t.select("a", "b", "common", (F.col("common") / (F.col("a_area") + F.col("b_area") - F.col("common"))).alias("iou"))
    return t if over is None else t.where(F.col("iou") > over)


def esri_to_geojson(rings: list[list[list[float]]]) -> dict | None:
    """GeoJSON of an ESRI ring list: clockwise rings are shells, each other ring a hole of the smallest shell around it."""
    def area(r):
        return sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1])) / 2

    def within(p, r):
        inside = False
        for (x1, y1), (x2, y2) in zip(r, r[1:] + r[:1]):
            if (y1 > p[1]) != (y2 > p[1]) and p[0] < x1 + (p[1] - y1) / (y2 - y1) * (x2 - x1):
                inside = not inside
        return inside

    rings = [[list(map(float, p[:2])) for p in r] for r in rings if len(r) >= 4]
    shells = [[r[::-1]] for r in rings if area(r) < 0]
    for hole in (r for r in rings if area(r) > 0):
        around = [s for s in shells if within(hole[0], s[0])]
        if around:
            min(around, key=lambda s: abs(area(s[0]))).append(hole[::-1])
    if not shells:
        return None
    return {"type": "Polygon", "coordinates": shells[0]} if len(shells) == 1 else {"type": "MultiPolygon", "coordinates": shells}


def geodesic_acres(square_degrees: Column, lat: Column) -> Column:
    """Acres of a small planar area on the authalic sphere at a latitude."""
    km2 = square_degrees * (math.pi * 6371.0072 / 180) ** 2 * F.cos(F.radians(lat))
    return km2 * 1e6 / 4046.8564224


def merged_parks(parks: DataFrame, pairs: DataFrame, precedence: dict[str, int], columns: list[str], *, name_over: float = 0.5, iou_over: float = 0.6, last: int = 99) -> DataFrame:
    """(cluster, source_id, natural_key, columns, merged_sources, merge_iou): parks of several sources that are one, once.

    `parks` is (key, source_id, natural_key, name_normalized, columns); `pairs` (a, b, iou) comes from overlap_pairs().
    Two parks of different sources are one if their boundaries' IoU and their names' similarity are both strictly above
    the limits; links chain. The survivor is the source of lowest precedence, then the smallest natural key; blanks are
    filled from the others in that order; merge_iou is the survivor's best pair, NULL for a park alone.
    """
    side = lambda x: parks.select(F.col("key").alias(x), F.col("source_id").alias("_s" + x), F.coalesce("name_normalized", F.lit("")).alias("_n" + x)).hint("merge")
    linked = pairs.where(F.col("iou") > iou_over).join(side("a"), "a").join(side("b"), "b").where((F.col("_sa") != F.col("_sb")) & (name_similarity(F.col("_na"), F.col("_nb")) > name_over))
    linked = materialize(linked.select("a", "b", "iou"), "linked")
    rows = parks.join(components(linked).withColumnRenamed("id", "key"), "key", "left").withColumn("cluster", F.coalesce("component", "key")).drop("component")
    best = linked.select("a", "iou").unionByName(linked.select(F.col("b").alias("a"), "iou")).groupBy(F.col("a").alias("key")).agg(F.max("iou").alias("best"))
    rows = rows.join(best, "key", "left")
    rank = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in precedence.items() for x in kv]), F.col("source_id")), F.lit(last))
    at = F.struct(rank.alias("r"), F.col("natural_key").alias("n"), F.col("source_id").alias("s"))
    picks = [F.min_by(F.col(c), F.when(~absent(F.col(c).cast("string")), at)).alias(c) for c in columns]
    out = rows.groupBy("cluster").agg(F.min_by(F.struct("source_id", "natural_key", "best"), at).alias("_b"), *picks, F.array_sort(F.collect_set(F.struct(at.alias("at"), F.col("key")))).alias("_m"))
    return out.select("cluster", "_b.source_id", "_b.natural_key", *columns, F.array_join(F.transform("_m", lambda m: m["key"]), ",").alias("merged_sources"), F.col("_b.best").alias("merge_iou"))
