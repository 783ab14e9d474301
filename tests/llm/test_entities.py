import random

from cadastra.llm import entities
from cadastra.llm.entities import FLOOR, attributes, candidates, matched_entities

COLS = "key string, name_raw string, name_normalized string, address string, city string, state string, zip5 string, phone_raw string, phone_normalized string, latitude double, longitude double, ein string"
BRANDS = ["ZULO", "GLASA", "BREMEY", "TANO", "SKOR", "FICKLOW", "WHILER", "CARUM", "DREXIL", "HOVLE", "JASTMAN", "KENBY", "LISLE", "MICKA", "NORER", "PRUNE", "QUILEN", "RINLOW", "SPOMET", "TULQUIST"]
KINDS = ["REGIONAL MEDICAL CENTER", "NURSING AND REHABILITATION CENTER", "HOME HEALTH SERVICES"]


def facility(i):
    b, k, town = BRANDS[i % 20], KINDS[i // 20 % 3], ["Skerhaven", "Wumilfield"][i % 2]
    return (f"f{i:02}", f"{b} {k}", f"{b} {k}", f"{100 + i} Elm{chr(65 + i % 20)} St", town, "TX", f"7500{i % 2}", f"555010{i:04}", f"555010{i:04}", 30 + i * 0.03, -90.0, f"{i:09}" if i % 3 else None)


def data():
    f = [facility(i) for i in range(60)]
    q = []
    for i in range(0, 60, 2):
        k, name, _, addr, town, st, z, p, pn, lat, lon, ein = f[i]
        short = name.replace("REGIONAL", "REG").replace("MEDICAL CENTER", "MED CTR").replace("HEALTH", "HLTH")
        q.append((f"q{i:02}", short, short, addr.replace(" St", " Street"), town.upper(), st, z, p if i % 4 else None, pn if i % 4 else None, None, None, ein))
    q.append(("other", "VORNEY DIALYSIS", "VORNEY DIALYSIS", f[0][3], f[0][4], "TX", f[0][6], "5559999999", "5559999999", None, None, None))
    q.append(("bare", None, None, None, None, None, None, None, None, float("nan"), None, None))
    return f, q


def test_matches_and_strangers(spark):
    f, q = data()
    got = {r.query: (r.record, r.confidence) for r in matched_entities(spark.createDataFrame(f, COLS), spark.createDataFrame(q, COLS)).collect()}
    assert {k: v[0] for k, v in got.items()} == {f"q{i:02}": f"f{i:02}" for i in range(0, 60, 2)}
    assert all(0.5 <= c <= 1 for _, c in got.values())


def test_candidates_against_scoring_all_pairs(spark):
    f, q = data()
    random.Random(1).shuffle(f)
    r, s = attributes(spark.createDataFrame(f, COLS)), attributes(spark.createDataFrame(q, COLS))
    few = {(x.query, x.record): round(x.score, 9) for x in candidates(r, s, k=1000).collect()}
    every = {(x.query, x.record): (round(x.score, 9), x.own) for x in candidates(r, s, k=1000, floor=0.0).collect()}
    assert few == {k: v for k, (v, own) in every.items() if v >= FLOOR * own}
    assert len(every) > 3 * len(few) > 0


def test_empty_tables(spark):
    f, q = data()
    none = spark.createDataFrame([], COLS)
    assert matched_entities(none, spark.createDataFrame(q, COLS)).count() == 0 and matched_entities(spark.createDataFrame(f, COLS), none).count() == 0


def test_the_k_best_are_exact_at_any_floor_and_split(spark, monkeypatch):
    towns = ["Oakton", "Elmford", "Pineville"]
    rows = [(f"r{i:02}", f"{['North', 'South', 'Green', 'Silver'][i % 4]} {['Lake', 'Hill'][i % 2]} Clinic", None, f"{i % 7 + 1} Main St", towns[i % 3], "TX", f"7500{i % 3}", None, f"55501000{i % 20:02}", None, None, None) for i in range(40)]
    cols = "key string, name_raw string, name_normalized string, address string, city string, state string, zip5 string, phone_raw string, phone_normalized string, latitude double, longitude double, ein string"
    r = entities.materialize(entities.attributes(spark.createDataFrame(rows, cols)), "r")
    q = entities.materialize(entities.attributes(spark.createDataFrame([("q" + x[0], *x[1:]) for x in rows[:12]], cols)), "q")
    every = {}
    for x in entities.candidates(r, q, k=10**6, floor=0.0).collect():
        every.setdefault(x.query, []).append((-round(x.score, 9), x.record, x.own))
    for k, floor, postings in ((3, 0.0, 5000), (3, 0.0, 1), (3, 0.4, 2)):
        monkeypatch.setattr(entities, "POSTINGS", postings)
        got = {(x.query, x.record) for x in entities.candidates(r, q, k=k, floor=floor).collect()}
        assert got == {(query, record) for query, found in every.items() for s, record, own in sorted(found)[:k] if -s >= floor * own - 1e-9}
