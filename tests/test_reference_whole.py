import hashlib
from datetime import datetime, timedelta

from cadastra.plans import reference


def test_provenance_holds_every_event(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(hours=i), i % 7, f'{{"k": {i % 20}}}') for i in range(60)] + [(60, None, 9, '{"k": 1}'), (61, start, 9, None)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {(r.natural_key, r.payload_sha): (r.first_run, r.last_run) for r in reference.source_record_upsert(spark, str(tmp_path)).collect()}
    runs: dict = {}
    for i, _, user, props in rows:
        if props:
            runs.setdefault((str(user), hashlib.sha256(props.encode()).hexdigest()), set()).add(1 if i < 30 else 2)
    assert got == {k: (min(v), max(v)) for k, v in runs.items()}


def test_pairs_of_every_block(spark, tmp_path):
    cols = "source_id string, natural_key string, vertical string, account_type string, name_raw string, name_normalized string, address_line_1 string, city string, state string, zip5 string, phone_raw string, phone_normalized string, latitude double, longitude double, segment string, ein string, size_value double, loaded_at timestamp"
    at = datetime(2024, 1, 1)

    def row(source, key, name, city, zip5, phone=None, lat=None, lon=None, state="TX"):
        return (source, key, "healthcare", "facility", name, name, "1 A ST", city, state, zip5, phone, phone, lat, lon, None, None, None, at)

    spark.createDataFrame([row("cms_general", "A", "OAK CLINIC", "FORT WORTH", "76101", "8175550100", 32.7, -97.3)], cols).write.parquet(f"{tmp_path}/cms_general.parquet")
    n = "nppes_practice_locations"
    spark.createDataFrame(
        [
            row(n, "zip", "OAK CLINIC", "Ft Worth", "76101-1234"),
            row(n, "phone", "ELM HOUSE", "DALLAS", "75201", "8175550100"),
            row(n, "cell", "ASH HOME", "DALLAS", "75201", None, 32.1, -97.9),
            row(n, "all", "OAK CLINIC", "FORT WORTH", "76101", "8175550100", 32.7, -97.3),
            row(n, "none", "OAK CLINIC", "FORT WORTH", "76102", None, 31.9, -97.3),
            row(n, "state", "OAK CLINIC", "FORT WORTH", "76101", "8175550100", state="FL"),
        ], cols,
    ).write.parquet(f"{tmp_path}/staging_sites.parquet")
    got = reference.pairs(spark, str(tmp_path)).select("key_a", "key_b").collect()
    assert sorted(r.key_b for r in got) == ["all", "cell", "phone", "zip"]


def test_every_document_has_a_certificate_status(spark, tmp_path):
    rows = [(1, "5. Oak HOA, 1 A St"), (2, "minutes of the board"), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.enrich_status for r in reference.certificate_fields(spark, str(tmp_path)).collect()} == {1: "ok", 2: "not_found", 3: "not_found"}


def test_parcels_of_every_state(spark, tmp_path):
    cols = "source_id string, natural_key string, vertical string, account_type string, name_raw string, name_normalized string, address_line_1 string, city string, state string, zip5 string, phone_raw string, phone_normalized string, latitude double, longitude double, segment string, ein string, size_value double, loaded_at timestamp"
    row = lambda source, key, state: (source, key, "healthcare", "facility", "N", "N", "12 MAIN ST", "T", state, "1", None, None, None, None, None, None, 1.0, datetime(2024, 1, 1))
    spark.createDataFrame([row("cms_general", "sc", "SC"), row("cms_general", "none", None)], cols).write.parquet(f"{tmp_path}/cms_general.parquet")
    spark.createDataFrame([row("nppes_practice_locations", "p", "SC")], cols).write.parquet(f"{tmp_path}/staging_sites.parquet")
    assert {r.key: (r.parcel, r.status) for r in reference.assessor_best_match(spark, str(tmp_path)).collect()} == {"sc": ("p", "found"), "none": (None, "bad_county")}
