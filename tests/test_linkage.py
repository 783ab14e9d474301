import math
import random

from pyspark.sql import functions as F

from cadastra.functions.similarity import _jaro_winkler, trigram_similarity
from cadastra.functions.text import certificate_ids, mailto_emails, normalize_name, normalize_phone, normalize_zip, packed_city, packed_street
from cadastra.operators import core, keyed, linkage, managers, quality
from cadastra.streaming.sinks import keyed_sink


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def test_normalizers(spark):
    assert one(spark, normalize_name(F.lit("L.L.C. Águila & Co., Inc."))) == "L L C GUILA"
    assert one(spark, normalize_name(F.lit(None).cast("string"))) == ""
    assert one(spark, normalize_zip(F.lit("1234"))) == "" and one(spark, normalize_zip(F.lit("12345-6789"))) == "12345"
    assert one(spark, normalize_phone(F.lit("+1 (555) 010-2000"))) == "15550102000"
    assert one(spark, packed_city(F.lit("1 A St, Suite 2, Town, TX 75000"))) == "Town" and one(spark, packed_street(F.lit("1 A St, Suite 2, Town, TX 75000"))) == "1 A St, Suite 2"
    assert one(spark, certificate_ids(F.lit("https://x/certificates/12/34/full/"))).certificate_id == "34"
    assert one(spark, mailto_emails(F.lit('<a href="mailto:A@b.c?x=1">,<a href="MAILTO:noreply@b.c">,<a href="mailto:a@b.c">'))) == ["a@b.c"]


def test_similarities(spark):
    assert abs(_jaro_winkler("MARTHA", "MARHTA") - 0.9611) < 1e-4 and _jaro_winkler("", "A") == 0 and _jaro_winkler("AB", "CD") == 0
    assert abs(one(spark, trigram_similarity(F.lit("AAAA"), F.lit("AAA"))) - 0.5) < 1e-12 and one(spark, trigram_similarity(F.lit("AB"), F.lit("ABC"))) == 0


def records(spark, n=140, seed=3):
    rng = random.Random(seed)
    base = [(f"{rng.choice(['Oak', 'Elm', 'Pine'])} {rng.choice(['Care', 'Clinic'])} {i // 4}", f"{i // 4} Main St", f"555010{i // 6:04}", "TX", f"750{i // 20:02}", 30 + (i // 5) * 0.01 + rng.random() * 0.002, -90 + rng.random() * 0.002, float(i % 3)) for i in range(n)]
    rows = [(f"r{i:03}", *r) for i, r in enumerate(base)] + [("z", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "id string, name string, address string, phone string, state string, zip5 string, latitude double, longitude double, size_value double")


def brute_score(a, b):
    from collections import Counter

    def sim(x, y):
        if not x or not y:
            return 0.0
        g = lambda s: Counter(s[i:i + 3] for i in range(len(s) - 2))
        t = 0.0 if min(len(x), len(y)) < 3 else sum((g(x) & g(y)).values()) / max(len(x) - 2, len(y) - 2)
        return 0.6 * _jaro_winkler(x, y) + 0.4 * t

    if a.latitude is None or b.latitude is None:
        near = 0.0
    else:
        h = math.sin(math.radians(b.latitude - a.latitude) / 2) ** 2 + math.cos(math.radians(a.latitude)) * math.cos(math.radians(b.latitude)) * math.sin(math.radians(b.longitude - a.longitude) / 2) ** 2
        near = max(0.0, 1 - 2 * 6371 * math.asin(math.sqrt(h)) / 0.5)
    m = max(a.size_value or 0, b.size_value or 0)
    size = 1.0 if a.size_value is not None and b.size_value is not None and m and abs(a.size_value - b.size_value) / m < 0.2 else 0.0
    return 0.35 * sim((a.name or "").upper(), (b.name or "").upper()) + 0.3 * sim((a.address or "").upper(), (b.address or "").upper()) + 0.2 * near + 0.1 * (bool(a.phone) and a.phone == b.phone) + 0.05 * size


def test_fuzzy_pairs_find_all_that_the_coarse_blocks_hold(spark):
    df = records(spark)
    rows = df.collect()

    def blocked(a, b):
        szn = (a.state, a.zip5, (a.name or "")[:4]) == (b.state, b.zip5, (b.name or "")[:4])
        geo = None not in (a.latitude, b.latitude) and (math.floor(a.latitude), math.floor(a.longitude)) == (math.floor(b.latitude), math.floor(b.longitude))
        return szn or (a.phone and (a.state, a.phone) == (b.state, b.phone)) or geo

    want = {(a.id, b.id): s for a in rows for b in rows if a.id < b.id and blocked(a, b) and (s := brute_score(a, b)) >= 0.75}
    got = {(r.a_id, r.b_id): r.score for r in linkage.fuzzy_pairs(df).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(want) > 50


def test_components_of_chains_stars_and_repeats(spark):
    links = [(f"c{i:02}", f"c{i + 1:02}") for i in range(30)] + [("s0", f"s{i}") for i in range(1, 20)] + [("b", "a"), ("a", "b"), ("x", "x"), (None, "q")]
    got = {r.id: r.component for r in linkage.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert {got[f"c{i:02}"] for i in range(31)} == {"c00"} and {got[f"s{i}"] for i in range(20)} == {"s0"} and got["b"] == "a" and got["x"] == "x" and "q" not in got
    assert linkage.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_tiers_and_survivors(spark):
    rows = [("s1", "1", "A", "75001", "TX", None, 30.0, -90.0), ("s2", "2", "A", "75001", "TX", "555", None, None), ("s1", "3", "B", "75001", "TX", " nan ", float("nan"), 1.0), ("s1", "4", "HCA HEALTHCARE", "1", "TX", None, 1.0, 1.0), ("s1", "5", "HCA HEALTHCARE", "1", "TX", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "source_id string, natural_key string, name string, zip5 string, state string, phone string, latitude double, longitude double")
    t = linkage.tier2(df.withColumn("cluster_id", linkage.tier1(df)))
    ids = {r.natural_key: r.cluster_id for r in t.collect()}
    assert ids["1"] == ids["2"] == "t2:A|75001|TX" and ids["3"] == "src:s1:3" and ids["4"] != ids["5"]
    got = {r.cluster_id: r for r in linkage.survivors(t, "cluster_id", ["name", "phone"], F.when(F.col("source_id") == "s2", 0).otherwise(1), F.col("natural_key"), F.col("natural_key")).collect()}
    pair = got["t2:A|75001|TX"]
    assert (pair.phone, pair.latitude, pair.merged_sources, pair.members) == ("555", 30.0, "2,1", 2) and got["src:s1:3"].phone is None and got["src:s1:3"].latitude is None


def test_manager_names(spark):
    def parse(s):
        r = one(spark, managers.parse_manager(F.lit(s)))
        return r.variants, r.entity_class

    assert parse("CITY OF CHARLESTON") == (["CHARLESTON"], "place")
    assert parse("BEAUFORT COUNTY") == (["BEAUFORT", "BEAUFORT COUNTY"], "county")
    assert parse("CITY OF BAY CITY") == (["BAY", "BAY CITY"], "place")
    assert parse("WAKE COUNTY PARKS RECREATION AND OPEN SPACE")[1] == "county"
    assert "WINTER PARK" in parse("City of Winter Park Parks and Recreation Department")[0]
    assert parse("PARKS DEPT")[0] == ["PARKS", "PARKS DEPT"] and parse("")[0] == []
    assert one(spark, managers.parse_manager(F.lit(None).cast("string"))).variants == []


def test_diff_applied_twice_is_empty(spark):
    cols = "k string, name string, status string"
    new = spark.createDataFrame([("a", "x", "active"), ("b", "y2", None), ("d", "n", "active")], cols)
    old = spark.createDataFrame([("a", "x", "active"), ("b", "y", None), ("c", "z", "active")], cols)
    acts = core.diff_actions(new, old, "k", ["name", "status"])
    assert {(r.k, r.action) for r in acts.collect()} == {("b", "update"), ("c", "tombstone"), ("d", "insert")}
    nxt = core.apply_diff(new, old, acts, "k", ["name", "status"])
    assert {(r.k, r.name, r.status) for r in nxt.collect()} == {("a", "x", "active"), ("b", "y2", None), ("c", "z", "merged"), ("d", "n", "active")}
    again = core.diff_actions(new, nxt, "k", ["name", "status"], gone_filter=F.coalesce(F.col("status") != "merged", F.lit(True)))
    assert again.count() == 0


def test_review_pairs_are_never_demoted(spark):
    cols = "source_id_a string, natural_key_a string, source_id_b string, natural_key_b string, merge_strategy string, score double, status string, ord int"
    old = spark.createDataFrame([("s", "1", "s", "2", "t", 0.8, "merged", 1), ("s", "3", "s", "4", "t", 0.7, "pending", 1)], cols)
    new = spark.createDataFrame([("s", "2", "s", "1", "t", 0.1, None, 1), ("s", "4", "s", "3", "t", 0.9, None, 1), ("s", "4", "s", "3", "t", 0.2, None, 2), ("s", "9", "s", "8", "t", 0.6, None, 1)], cols)
    got = {(r.natural_key_a, r.natural_key_b): (r.score, r.status) for r in core.upsert_review_pairs(old, new).collect()}
    assert got == {("1", "2"): (0.8, "merged"), ("3", "4"): (0.9, "pending"), ("8", "9"): (0.6, "pending")}


def test_keyed_tables(spark):
    old = spark.createDataFrame([("a", "1", None), ("b", " ", "q")], "k string, x string, y string")
    new = spark.createDataFrame([("b", "2", "r"), ("c", None, None)], "k string, x string, y string")
    assert {tuple(r) for r in keyed.upsert(old, new, ["k"]).collect()} == {("a", "1", None), ("b", "2", "r"), ("c", None, None)}
    assert {r.k for r in keyed.changed_rows(old, new, ["k"], ["x", "y"]).collect()} == {"b", "c"}
    assert {tuple(r) for r in keyed.fill_blanks(old, new, ["k"], ["x", "y"]).collect()} == {("a", "1", None), ("b", "2", "q")}


def test_quality_gate(spark):
    import pytest

    df = spark.createDataFrame([("a", "x"), (None, "y")], "k string, c string")
    assert quality.require(df, min_rows=2, fill={"k": 0.5})["rows"] == 2
    with pytest.raises(ValueError, match="blank"):
        quality.require(df, key="k")
    with pytest.raises(ValueError, match="unknown"):
        quality.require(df, domains={"c": {"x"}})
    assert quality.require(df.limit(0), fill={"k": 0.9})["rows"] == 0
    assert {r.column_name: r.fill_rate for r in quality.fill_rates(df, ["k", "c"]).collect()} == {"k": 0.5, "c": 1.0}


def test_stream_into_a_keyed_table(spark, tmp_path):
    schema = "k string, v int, at int"
    write = keyed_sink(str(tmp_path / "t"), schema, ["k"], "at")
    first = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 1)], schema)
    write(first, 0)
    write(first, 0)
    write(spark.createDataFrame([("b", 5, 3)], schema), 1)
    assert {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "t" / "v1")).collect()} == {("a", 2), ("b", 5)}
