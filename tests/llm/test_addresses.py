from cadastra.llm import addresses
from cadastra.llm.addresses import place_pairs, same_places, signatures

COLS = "key string, address string, city string, state string, zip5 string"
TOWNS = [(f"t{i}", f"{900 + i} Filler{chr(65 + i)} Rd", c, "TX", z) for i, (c, z) in enumerate([("Lake Brodanburg", "75001"), ("Wumilfield", "75002"), ("Skerhaven", "75003")] * 4)]


def pairs(spark, rows):
    return {(r.rec_a, r.rec_b) for r in same_places(spark.createDataFrame(rows + TOWNS, COLS)).collect() if not r.rec_a.startswith("t")}


def test_one_place_in_many_spellings(spark):
    same = [
        ("a1", "336 N. Saint Orlan Boulevard, Suite #D", "Lk. Brodanburg", "TX", "75001"), ("a2", "336 North St Orlan Blvd", "LAKE BRODANBURG", "TX", None), ("a3", "c/o Oak Management\nSte D, 336 St. Orlan Blvd N; Lake Brodanburg, Texas 75001-1234", None, None, None),
        ("a4", "75001 LAKE BRODANBURG TX - 336, N ST ORLNA BLVD", None, None, None), ("a5", "336 N Saint Orlan, Lake Brodnaburg", None, None, None), ("a6", "336 N ORLAN BLVD TX 75001", None, None, None),
    ]
    other = [
        ("b1", "336 N Saint Orlan Ct", "Lake Brodanburg", "TX", "75001"), ("b2", "336 S Saint Orlan Blvd", "Lake Brodanburg", "TX", "75001"), ("b3", "337 N Saint Orlan Blvd", "Lake Brodanburg", "TX", "75001"),
        ("b4", "336 N Saint Orlan Blvd", "Wumilfield", "TX", "75002"), ("b5", None, "Lake Brodanburg", "TX", "75001"), ("b6", "nan", "Lake Brodanburg", "TX", "75001"), ("b7", "see field 6", None, None, None), ("b8", "", None, None, None), (None, "336 N Saint Orlan Blvd", "Lake Brodanburg", "TX", "75001"),
    ]
    got = pairs(spark, same + other)
    spelled = {f"a{i}" for i in range(1, 6)}
    assert {(x, y) for x in spelled for y in spelled if x < y} <= got
    # without a type, a5 may be the boulevard or the court; all others are told apart
    assert {p for p in got if p[1].startswith("b")} <= {("a5", "b1")}


def test_boxes_numbered_roads_and_number_words(spark):
    rows = [
        ("a1", "P.O. Box 12", "Skerhaven", "TX", None), ("a2", "POB 12, Skerhaven TX", None, None, None), ("a3", "PO Box 13", "Skerhaven", "TX", None), ("c1", "43 Farm to Market Rd 1005", "Skerhaven", "TX", None), ("c2", "43 F.M. 1005", "SKERHAVEN", "TX", None), ("c3", "43 Co Rd 1005", "Skerhaven", "TX", None),
        ("d1", "Eight Fifth Av", "Skerhaven", "TX", None), ("d2", "8 5TH AVENUE FL 2ND", "Skerhaven", "TX", None), ("e1", "12676, Live Oak Trl", "Skerhaven", "TX", None), ("e2", "12676 LIVEOAK TRAIL", "Skerhaven", "TX", None),
    ]
    assert pairs(spark, rows) == {("a1", "a2"), ("c1", "c2"), ("d1", "d2"), ("e1", "e2")}


def test_repeats_long_texts_and_empty_tables(spark):
    rows = [("a1", "5 Elm St", "Skerhaven", "TX", None), ("a1", "5 Elm St", "Skerhaven", "TX", None), ("a2", "5 Elm Street", "Skerhaven", "TX", None), ("x", "7 " + "Word " * 3000, "Skerhaven", "TX", None)]
    assert pairs(spark, rows) == {("a1", "a2")}
    assert same_places(spark.createDataFrame([], COLS)).count() == 0 and signatures(spark.createDataFrame([], COLS)).count() == 0


def test_one_town_name_in_three_states(spark):
    rows = [("a1", "5 Elm St", "Springdale", "TX", "75001"), ("a2", "5 Elm Street", "SPRINGDALE", "Texas", None), ("b1", "5 Elm St", "Springdale", "FL", "32601"), ("b2", "5 Elm St, Springdale, FL 32601", None, None, None), ("c1", "5 Elm St", "Springdale", "NC", None)]
    assert pairs(spark, rows) == {("a1", "a2"), ("b1", "b2")}


def letters(i):
    return "".join(chr(65 + i // 26**k % 26) for k in range(4))


def test_one_street_of_every_town_meets_nobody(spark):
    n = 3000
    rows = [(f"k{i}", "100 Main St", f"Qu{letters(i * 7919)}zho", "TX", None) for i in range(n)]
    df = spark.createDataFrame(rows, COLS)
    own, found = place_pairs(df)
    assert own.count() == n
    distinct = signatures(df).withColumn("rarity", addresses.F.create_map().cast("map<string,double>")).withColumn("place", addresses.F.xxhash64("key"))
    a, b = addresses._blocks(distinct)
    # towns an edit apart may meet; the number and the word alone never do
    assert a.select("block").join(b.select("block"), "block").count() <= 30 * n


def test_a_town_of_many_streets_is_split_by_rare_words_without_loss(spark, monkeypatch):
    rows = [(f"k{i:03}", f"7 {letters(i * 7919)}ton {['Creek', 'Ridge'][i % 2]} Rd", "Skerhaven", "TX", None) for i in range(60)]
    rows += [("s1", "7 Wellington Creek Rd", "Skerhaven", "TX", None), ("s2", "7 Welingtn Creek Rd", "Skerhaven", "TX", None), ("s3", "7 Wellingtno Creek", "Skerhaven", "TX", None), ("s4", "7 Live Oak Rd", "Skerhaven", "TX", None), ("s5", "7 Liveoka Rd", "Skerhaven", "TX", None)]
    whole = pairs(spark, rows)
    assert {("s1", "s2"), ("s1", "s3"), ("s4", "s5")} <= whole
    monkeypatch.setattr(addresses, "BLOCK", 1)
    monkeypatch.setattr(addresses, "MEMBERS", 1)
    assert pairs(spark, rows) == whole


def test_copies_of_one_address(spark):
    rows = [(f"k{i:02}", "9 Oak Ln", "Skerhaven", "TX", None) for i in range(30)]
    assert len(pairs(spark, rows)) == 30 * 29 // 2
    own, found = place_pairs(spark.createDataFrame(rows, COLS))
    assert own.select("place").distinct().count() == 1 and found.count() == 0
