import json

from pyspark.sql import functions as F

from cadastra.sources import specs


def test_csv_to_canonical(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('Name,Zip,ST,Lat,Extra\n"Oak, Inc.",75001-22,TX,30.5,\nElm,1,ZZ,bad,x\n')
    raw = specs.read_csv(spark, str(p), ["Name", "Zip", "ST", "Lat"])
    spec = specs.SourceSpec("s", "v", {"name_raw": "Name", "zip5": "Zip", "state": "ST", "latitude": "Lat", "natural_key": lambda df: F.sha2("Name", 256), "source_file": "source_file"}, states=specs.STATES)
    (r,) = specs.canonical(raw, spec).collect()
    assert specs.canonical(raw, spec).columns == specs.CANONICAL
    assert (r.name_normalized, r.zip5, r.latitude, r.city, r.source_file) == ("OAK", "75001", 30.5, None, "x.csv")


def test_features_and_pages(spark, tmp_path):
    f = tmp_path / "f.jsonl"
    f.write_text(json.dumps({"properties": {"name": "A"}, "geometry": {"type": "Point", "coordinates": [1.5, 2.5]}}) + "\n" + json.dumps({"attributes": {"Name": "B"}, "geometry": {"x": 3, "y": 4}}) + "\n\n")
    got = [(r.props["NAME"], r.lon, r.lat) for r in specs.read_features(spark, str(f)).collect()]
    assert got == [("A", 1.5, 2.5), ("B", 3.0, 4.0)]
    g = tmp_path / "p.json"
    g.write_text(json.dumps({"results": [{"a": 1}, {"a": "x"}]}))
    assert [r.row["a"] for r in specs.read_pages(spark, str(g)).collect()] == ["1", "x"]


def test_landing_is_by_content(tmp_path):
    a = specs.land(b"x", str(tmp_path), "s", "2026-01-01", "csv")
    assert specs.land(b"x", str(tmp_path), "s", "2026-01-01", "csv") == a and specs.land(b"y", str(tmp_path), "s", "2026-01-01", "csv") != a
