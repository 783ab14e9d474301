import json
import math
import random

from cadastra.operators.polygons import esri_to_geojson, overlap_pairs
from cadastra.operators.spatial import containing_regions, near_pairs


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def test_near_pairs_against_brute_force_with_hot_cells(spark):
    rng = random.Random(1)
    pts = {f"k{i}": (rng.choice([24.0, 43.0, -0.001, 60.0]) + rng.gauss(0, 0.002), rng.gauss(-80, 0.002)) for i in range(500)}
    pts |= {f"same{i}": (30.0, -90.0) for i in range(40)}
    rows = [(k, *p) for k, p in pts.items()] + [("none", None, -80.0), ("nan", float("nan"), -80.0), (None, 30.0, -90.0), ("k1", *pts["k1"])]
    df = spark.createDataFrame(rows, "key string, lat double, lon double")
    want = {(a, b) for a in pts for b in pts if a < b and km(pts[a], pts[b]) <= 0.1}
    for hot in (2000, 5):
        got = [(r.key_a, r.key_b) for r in near_pairs(df, 0.1, hot_points=hot).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert near_pairs(df.limit(0), 0.1).count() == 0


def test_regions_with_holes_and_several_polygons(spark):
    square = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    shapes = [
        ("ring", json.dumps({"type": "Polygon", "coordinates": [square(0, 0, 4), square(1, 1, 2)]})), ("two", json.dumps({"type": "MultiPolygon", "coordinates": [[square(10, 0, 1)], [square(12, 0, 1)]]})),
        ("none", None), ("odd", "{}"), ("point", json.dumps({"type": "Point", "coordinates": [0, 0]})),
    ]
    pts = [("edge", 0.5, 0.5), ("hole", 2.0, 2.0), ("p", 0.5, 10.5), ("q", 0.5, 11.5), ("r", 0.5, 12.5), ("n", None, 1.0), (None, 0.5, 0.5)]
    got = containing_regions(spark.createDataFrame(pts, "key string, lat double, lon double"), spark.createDataFrame(shapes, "region string, geojson string"))
    assert {(r.key, r.region) for r in got.collect()} == {("edge", "ring"), ("p", "two"), ("r", "two")}


def test_overlap_of_a_triangle_and_a_ring(spark):
    tri = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [0, 4], [0, 0]]]})
    hole = json.dumps({"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]], [[0.5, 0.5], [1, 0.5], [1, 1], [0.5, 1], [0.5, 0.5]]]})
    df = spark.createDataFrame([("a", tri), ("b", hole), ("c", None)], "key string, geojson string")
    (r,) = overlap_pairs(df, df, same=True).collect()
    assert abs(r.common - 3.75) < 1e-9 and abs(r.iou - 3.75 / 8) < 1e-9


def test_esri_rings():
    shell = [[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    assert len(esri_to_geojson([shell, hole])["coordinates"]) == 2
    assert esri_to_geojson([hole]) is None


def test_pairs_across_180_degrees_once(spark):
    rows = [("a", 0.0, 179.9999), ("b", 0.0, -179.9999), ("c", 0.0003, -179.9998), ("d", -0.0002, 179.9998), ("e", 0.0, 179.0), ("a", 0.5, 0.0)]
    got = [(r.key_a, r.key_b) for r in near_pairs(spark.createDataFrame(rows, "key string, lat double, lon double"), 0.1).collect()]
    assert sorted(got) == [("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d")]
