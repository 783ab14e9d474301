"""Points near other points or inside regions: grid cells sized by the radius, exact checks after an equi-join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.geo import KM_PER_DEGREE, haversine_km, polygons, usable
from cadastra.runtime import broadcast_if_small, materialize

#: Cells with more points than this are split into sub-blocks for the join.
HOT_CELL_POINTS = 2000


def _lon_width(band: Column, step: float) -> Column:
    """Degrees of longitude that span the radius anywhere in a latitude band, poles guarded."""
    edge = F.greatest(F.abs(band * step), F.abs((band + 1) * step))
    return F.lit(step) / F.greatest(F.cos(F.radians(F.least(edge, F.lit(89.9)))), F.lit(1e-6))


def near_pairs(points: DataFrame, radius_km: float, *, key: str = "key", lat: str = "lat", lon: str = "lon", hot_points: int = HOT_CELL_POINTS) -> DataFrame:
    """(key_a, key_b, distance_km): every pair of points at most `radius_km` apart, key_a the smaller.

    Points without a usable coordinate or key are in no pair; a key that stands twice is paired
    once, by its smallest latitude, then longitude; a pair of equal keys is none. Empty input gives an empty result. Cells of more than
    `hot_points` points are split on one side and repeated on the other, so that no task holds a
    whole cell. Points on both sides of 180 degrees meet: those near it on the west side stand once more beyond -180.
    """
    step = radius_km / KM_PER_DEGREE * 1.000001
    at = points.select(F.col(key).alias("k"), F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x"))
    at = at.where(F.col("k").isNotNull() & usable(F.col("y"), F.col("x"))).groupBy("k").agg(F.min(F.struct("y", "x")).alias("p")).select("k", "p.y", "p.x")
    near_pole = F.lit(step) / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("y")) + step, F.lit(89.9)))), F.lit(1e-6))
    at = at.withColumn("x", F.explode(F.when(F.col("x") + near_pole >= 180, F.array(F.col("x"), F.col("x") - 360)).otherwise(F.array("x"))))
    at = at.withColumn("cy", F.floor(F.col("y") / step))
    at = at.withColumn("cx", F.floor(F.col("x") / _lon_width(F.col("cy"), step)))

    # forward half of the neighbourhood: own cell and the one to the right, and the row above
    reach = F.lit(step) / F.greatest(F.cos(F.radians(F.least(F.abs(F.col("y")) + step, F.lit(89.9)))), F.lit(1e-6))
    above = F.col("cy") + 1
    wide = _lon_width(above, step)
    cells = F.concat(
        F.array(F.struct(F.col("cy").alias("cy"), F.col("cx").alias("cx")), F.struct(F.col("cy").alias("cy"), (F.col("cx") + 1).alias("cx"))),
        F.transform(F.sequence(F.floor((F.col("x") - reach) / wide), F.floor((F.col("x") + reach) / wide)), lambda c: F.struct(above.alias("cy"), c.alias("cx"))),
    )
    hot = at.groupBy("cy", "cx").count().where(F.col("count") > hot_points).select("cy", "cx", F.ceil(F.col("count") / hot_points).cast("int").alias("blocks"))
    here = at.join(hot, ["cy", "cx"], "left").select(F.col("k").alias("k2"), F.col("y").alias("y2"), F.col("x").alias("x2"), "cy", "cx", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("k"), F.col("blocks"))).cast("int").alias("block"))
    there = at.select("k", "y", "x", F.col("cy").alias("own_y"), F.col("cx").alias("own_x"), F.inline(cells))
    there = there.join(hot, ["cy", "cx"], "left").withColumn("block", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))

    same_cell = (F.col("own_y") == F.col("cy")) & (F.col("own_x") == F.col("cx"))
    near = there.join(here, ["cy", "cx", "block"]).where((~same_cell & (F.col("k") != F.col("k2"))) | (F.col("k") < F.col("k2")))
    near = near.where((F.abs(F.col("y") - F.col("y2")) <= step) & ((F.col("x") >= -180) | (F.col("x2") >= -180)))
    return near.select(
        F.least("k", "k2").alias("key_a"), F.greatest("k", "k2").alias("key_b"),
        haversine_km(F.col("y"), F.col("x"), F.col("y2"), F.col("x2")).alias("distance_km"),
    ).where(F.col("distance_km") <= radius_km)


def region_edges(regions: DataFrame, *, region: str = "region", geojson: str = "geojson", strip: float = 0.02, block: float = 0.5) -> DataFrame:
    """Edges of every polygon, repeated for each latitude strip they touch and each longitude block from the
    polygon's west end to their own east end: all that a ray to the east from a point there may cross."""
    parts = regions.where(F.col(region).isNotNull()).select(F.col(region).alias("region"), F.posexplode(polygons(F.col(geojson))).alias("part", "rings"))
    parts = parts.withColumn("west", F.array_min(F.transform(F.flatten(F.col("rings")), lambda p: p[0])))
    rings = parts.select("region", "part", "west", F.explode("rings").alias("ring"))
    n = F.size("ring")
    pair = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.col("ring")[i][0].alias("x1"), F.col("ring")[i][1].alias("y1"),
        F.col("ring")[F.pmod(i + 1, n)][0].alias("x2"), F.col("ring")[F.pmod(i + 1, n)][1].alias("y2"),
    ))
    edges = rings.where(n >= 3).select("region", "part", "west", F.inline(pair)).where(F.col("y1") != F.col("y2"))
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    edges = edges.withColumn("strip", F.explode(F.sequence(F.floor(low / strip), F.floor(high / strip))))
    return edges.withColumn("block", F.explode(F.sequence(F.floor(F.col("west") / block), F.floor(F.greatest("x1", "x2") / block)))).drop("west")


def containing_regions(points: DataFrame, regions: DataFrame, *, key: str = "key", lat: str = "lat", lon: str = "lon", region: str = "region", geojson: str = "geojson", strip: float = 0.02, block: float = 0.5) -> DataFrame:
    """(key, region): every region whose polygon contains the point, holes being outside.

    Even-odd rule per polygon, edges straight in lon/lat and half open in latitude, so a point on
    an edge shared by two regions is in one of them. Regions with NULL or other geometry contain
    nothing; points without a usable coordinate are nowhere. The edge table is written once; it is
    broadcast only if its files are small, else Spark joins it by strip and block.
    """
    edges = materialize(region_edges(regions, region=region, geojson=geojson, strip=strip, block=block), "edges")
    at = points.select(F.col(key).alias("key"), F.col(lat).cast("double").alias("y"), F.col(lon).cast("double").alias("x"))
    at = at.where(F.col("key").isNotNull() & usable(F.col("y"), F.col("x")))
    at = at.withColumn("strip", F.floor(F.col("y") / strip)).withColumn("block", F.floor(F.col("x") / block))
    y, x = F.col("y"), F.col("x")
    crosses = (F.col("y1") > y).__ne__(F.col("y2") > y) & (x < F.col("x1") + (y - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1")))
    hits = at.join(broadcast_if_small(edges), ["strip", "block"]).where(crosses)
    inside = hits.groupBy("key", "region", "part").agg(F.count("*").alias("n")).where(F.col("n") % 2 == 1)
    return inside.select("key", "region").distinct()
