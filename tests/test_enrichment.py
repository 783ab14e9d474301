from pyspark.sql import functions as F

from cadastra.functions.certificates import certificate_fields, name_and_address, parse_certificate
from cadastra.operators import enrichment


def test_numbered_certificate():
    got = parse_certificate("5. Name and mailing address of the Association\nOak HOA\nPO Box 5\nTown, TX 75001\n6. Jane Doe, 1 A St, Town TX 75001\nPhone (555) 010-2000 jane@oak.com\n7. https://oak.com/docs).\n8. x")
    assert (got["hoa_name"], got["hoa_mailing_address"]) == ("Oak HOA", "PO Box 5, Town, TX 75001")
    assert (got["mgmt_phone_normalized"], got["mgmt_email"], got["website"]) == ("5550102000", "jane@oak.com", "https://oak.com/docs")
    assert got["confidence"] == 1.0 and not got["needs_review"] and got["enrich_status"] == "ok"


def test_labels_order_and_blanks(spark):
    got = parse_certificate("7. oak.org\nName and mailing address of the association: Oak HOA, 1 A St")
    assert got["website"] == "oak.org" and "anchor_order" in got["review_reasons"] and "field_5_label_fallback" in got["review_reasons"]
    rows = spark.createDataFrame([(1, None), (2, " "), (3, "x" * 9000), (4, "5. " + "y" * 9000)], "i int, t string").select("i", certificate_fields(F.col("t")).alias("f")).collect()
    assert [r.f.enrich_status for r in rows] == ["not_found"] * 3 + ["ok"] and len(rows[3].f.assoc_mailing_address) == 4000 and "value_truncated" in rows[3].f.review_reasons
    assert name_and_address(None) == (None, None) and name_and_address("Oak, 1 A St, Town") == ("Oak", "1 A St, Town")


def test_best_address_falls_back_to_the_whole_county(spark):
    loc = spark.createDataFrame([("a", "X", "12 Main Street"), ("b", "X", "Old Mill Rd 5"), ("c", "Z", "1 A St"), ("d", "X", None)], "key string, county string, address string")
    par = spark.createDataFrame([("p1", "X", "12 Main Stret", "1,234.5"), ("p2", "X", "99 Old Mill Rd 5", "0"), ("p3", "X", None, "5")], "parcel string, county string, address string, acres string")
    got = {r.key: (r.parcel, r.acres, r.status) for r in enrichment.best_address(loc, par).collect()}
    assert got == {"a": ("p1", 1234.5, "ok"), "b": ("p2", None, "no_acreage"), "c": (None, None, "bad_county"), "d": (None, None, "no_match")}


def test_geocoder_lines(spark):
    lines = spark.createDataFrame([('1,"a, b",Match,Exact,"A","-90.5,30.25",t,L',), ('2,"a",Match,Non_Exact,"A","-90.5,30.25",t,L',), ('3,"a",No_Match',), ("",)], "value string")
    got = {r.id: (r.latitude, r.longitude, r.precision, r.status) for r in enrichment.geocoder_answers(lines).collect()}
    assert got == {"1": (30.25, -90.5, "rooftop", "ok"), "2": (30.25, -90.5, "street", "ok"), "3": (None, None, None, "no_match")}
