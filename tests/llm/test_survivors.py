import datetime as dt
import random

from pyspark.sql import functions as F

from cadastra.llm.survivors import fused_values, surviving_records, usable_acres, usable_phone

T0 = dt.datetime(2026, 1, 1)
COLS = "cluster_id string, record_key string, source_id string, acres double, phone string, loaded_at timestamp, trust_rank string"


def run(spark, rows, ranks):
    m = spark.createDataFrame(rows, COLS).drop("trust_rank").withColumn("_clash", F.lit(1))
    r = spark.createDataFrame(ranks, "source_id string, trust_rank int")
    got = surviving_records(m, r, {"acres": usable_acres(F.col("acres")), "phone": usable_phone(F.col("phone"))})
    return {(x.cluster_id, x.field_name): x.record_key for x in got.collect()}


def test_trust_then_stamp_then_key(spark):
    d = lambda n: T0 + dt.timedelta(days=n)
    rows = [
        ("c", "a:1", "a", 0.0, "(999) 999-9999", d(9), None), ("c", "b:2", "b", 5.0, "555", d(1), None), ("c", "b:1", "b", 6.0, "5550102222", d(1), None), ("c", "x:1", "x", 7.0, "1-555-010-2222", d(9), None),
        ("solo", "a:9", "a", 5.0, None, d(1), None), ("none", "a:5", "a", None, "nan", None, None), ("none", "b:5", "b", float("nan"), "0000000000", None, None), (None, "a:7", "a", 1.0, None, d(1), None), (None, "a:8", "a", 1.0, None, d(1), None),
        ("late", "b:8", "b", 1.0, None, d(1), None), ("late", "b:9", "b", 2.0, None, d(2), None), ("late", "b:7", "b", 3.0, None, None, None),
    ]
    got = run(spark, rows, [("a", 1), ("b", 2), ("b", 2), (None, 0)])
    assert got == {("c", "acres"): "b:1", ("c", "phone"): "b:1", ("late", "acres"): "b:9"}
    assert run(spark, [], [("a", 1)]) == {}


def test_fusion_discounts_copied_votes(spark):
    rng = random.Random(8)
    claims, votes = [], 0
    for i in range(80):
        said = [f"t{i}" if rng.random() < 0.75 else f"w{i}-{s}" for s in range(5)]
        copied = f"w{i}" if i % 2 else f"t{i}"
        claims += [(f"g{i}", "f", f"good{s}", v) for s, v in enumerate(said)] + [(f"g{i}", "f", f"copy{s}", copied) for s in range(4)]
        votes += i % 2 == 0 or said.count(f"t{i}") > 4
    claims += [("g0", "f", None, "z"), (None, "f", "good1", "z"), ("g0", "f", "copy1", "t0"), ("g1", "f", "good1", None)]
    out = fused_values(spark.createDataFrame(claims, "grp string, field string, source string, value string"), rounds=4)
    got = {r.grp: r.value for r in out.collect()}
    assert len(got) == 80 and sum(got[f"g{i}"] == f"t{i}" for i in range(80)) >= 74 > votes
    assert fused_values(spark.createDataFrame([], "grp string, field string, source string, value string")).count() == 0

