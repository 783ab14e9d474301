import json
import random

import pytest
from pyspark.sql import functions as F

from cadastra.operators import polygons


def polygon(*ring):
    return json.dumps({"type": "Polygon", "coordinates": [[*map(list, ring), list(ring[0])]]})


def square(x, y, w, h):
    return polygon((x, y), (x + w, y), (x + w, y + h), (x, y + h))


def test_cells_of_a_box_are_never_broadcast(spark, monkeypatch):
    plans, write = [], polygons.materialize
    monkeypatch.setattr(polygons, "materialize", lambda df, tag: plans.append(df) or write(df, tag))
    df = spark.createDataFrame([(i, square(i / 4, 0, 1, 1)) for i in range(20)], "key long, geojson string")
    plans.append(polygons.overlap_pairs(df, df, same=True))
    assert plans[-1].count() == 19 + 18 + 17
    texts = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    cells = [t for t in texts if "Generate" in t and "Join" in t]
    assert cells and not [t for t in cells if "BroadcastHashJoin" in t or "BroadcastNestedLoopJoin" in t]


def test_a_limit_drops_no_pair_above_it(spark):
    dice = random.Random(3)
    shapes = [square(dice.random() * 3, dice.random() * 3, 0.4 + dice.random(), 0.4 + dice.random()) for _ in range(30)]
    shapes += [polygon((x := dice.random() * 3, y := dice.random() * 3), (x + 1, y), (x + dice.random(), y + 1)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(shapes)), "key long, geojson string")
    want = {(r.a, r.b): r.iou for r in polygons.overlap_pairs(df, df, same=True).collect()}
    edges = [polygons._edges(s) for s in shapes]
    area = [polygons.intersection_area(e, e) for e in edges]
    exact = {}
    for a in range(50):
        for b in range(a + 1, 50):
            if common := polygons.intersection_area(edges[a], edges[b]):
                exact[a, b] = common / (area[a] + area[b] - common)
    assert want == pytest.approx(exact, abs=1e-9)
    for over in (0.1, 0.3):
        assert {(r.a, r.b) for r in polygons.overlap_pairs(df, df, same=True, over=over).collect()} == {k for k, v in exact.items() if v > over}


def test_what_fills_its_box(spark):
    ring = [[0, 0], [2, 0], [2, 1], [0, 1], [0, 0]]
    rows = [
        ("box", square(0, 0, 2, 1)), ("turned", polygon((0, 0), (0, 1), (2, 1), (2, 0))), ("slanted", polygon((0, 0), (2, 0), (3, 1), (1, 1))),
        ("three", polygon((0, 0), (2, 0), (2, 1))), ("bow", polygon((0, 0), (2, 1), (2, 0), (0, 1))), ("none", None), ("odd", "{}"),
        ("hole", json.dumps({"type": "Polygon", "coordinates": [ring, ring]})), ("two", json.dumps({"type": "MultiPolygon", "coordinates": [[ring], [ring]]})), ("one", json.dumps({"type": "MultiPolygon", "coordinates": [[ring]]})),
    ]
    got = {r.key for r in spark.createDataFrame(rows, "key string, geojson string").where(polygons.is_box(F.col("geojson"))).collect()}
    assert got == {"box", "turned", "one"}


def test_parks_are_never_broadcast(spark, monkeypatch):
    plans, write = [], polygons.materialize
    monkeypatch.setattr(polygons, "materialize", lambda df, tag: plans.append(df) or write(df, tag))
    parks = spark.createDataFrame([(1, "padus_parks", "1", "OAK", "M"), (2, "state_parks", "2", "OAK", None), (3, "state_parks", "3", "OAK", None)], "key long, source_id string, natural_key string, name_normalized string, manager string")
    pairs = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.9), (1, 3, 0.5)], "a long, b long, iou double")
    got = polygons.merged_parks(parks, pairs, {"padus_parks": 10}, ["manager"]).collect()
    assert sorted((r.natural_key, r.manager, r.merged_sources, r.merge_iou) for r in got) == [("1", "M", "1,2", 0.9), ("3", None, "3", None)]
    assert plans and not [p for p in plans if "Broadcast" in p._jdf.queryExecution().executedPlan().toString()]
