"""Queries of the general problems: p1 snapshot changes, p2 nearby points and regions, p6 units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions.geo import usable
from cadastra.operators.snapshots import changed_records
from cadastra.operators.spatial import containing_regions, near_pairs
from cadastra.operators.unit_model import inferred_units
from cadastra.operators.units import convert_sizes, positive_amounts
from cadastra.runtime import absent, latest_rows, materialize, record_key, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = changed_records(table(spark, sf_dir, "resolved_account"), "account_key", json_columns=("mailing_address", "external_keys"))
    locations = changed_records(table(spark, sf_dir, "resolved_location"), "location_key", json_columns=("site_address",))
    return (
        accounts.select(F.lit("resolved_account").alias("table_name"), "*")
        .unionByName(locations.select(F.lit("resolved_location").alias("table_name"), "*"))
        .select("table_name", "record_key", "snapshot_no", "change_kind")
    )


#: min lat, max lat, min lon, max lon of a usable position
POSITION_BOX = (24.0, 43.0, -107.0, -74.0)
NEAR_KM = 0.1


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, lat, lon) of the current staging_sites rows with a usable position."""
    rows = latest_rows(table(spark, sf_dir, "staging_sites"), ["source_id", "natural_key"], columns=["latitude", "longitude", "loaded_at"])
    return rows.where(usable(F.col("latitude"), F.col("longitude"), POSITION_BOX)).select(record_key().alias("key"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = materialize(positions(spark, sf_dir), "positions")
    near = near_pairs(points, NEAR_KM).select(F.lit("near").alias("relation"), "key_a", "key_b")
    units = table(spark, sf_dir, "gov_unit_boundary").select(F.col("natural_key").alias("region"), F.col("boundary_geojson").alias("geojson"))
    inside = containing_regions(points, units).select(F.lit("in").alias("relation"), F.col("key").alias("key_a"), F.col("region").alias("key_b"))
    return near.unionByName(inside)


def site_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current staging_sites rows with their sizes converted."""
    sites = latest_rows(table(spark, sf_dir, "staging_sites"), ["source_id", "natural_key"], columns=["source_id", "natural_key", "account_type", "vertical", "name_normalized", "size_value", "size_unit", "size_metric", "loaded_at"])
    return convert_sizes(sites, value="size_value", unit="size_unit", label="size_metric")


def account_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """resolved_account rows of the newest snapshot holding each key, with their sizes converted."""
    t = table(spark, sf_dir, "resolved_account").select("account_key", "vertical", "account_type", "size_metric", "size_metric_unit", F.struct("snapshot_no", "loaded_at").alias("newest"))
    return convert_sizes(latest_rows(t, ["account_key"], "newest"), value="size_metric", unit="size_metric_unit")


def all_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of both tables with what the unit model reads."""
    columns = ["table_name", "record_key", "source_id", "account_type", "name_normalized", "size_given", "size_unit_name", "unit_text"]
    sites = site_sizes(spark, sf_dir).select(F.lit("staging_sites").alias("table_name"), record_key().alias("record_key"), *columns[2:7], F.when(absent(F.col("size_unit")), F.col("size_metric")).otherwise(F.col("size_unit")).alias("unit_text"))
    accounts = account_sizes(spark, sf_dir).select(F.lit("resolved_account").alias("table_name"), F.col("account_key").alias("record_key"), F.col("vertical").alias("source_id"), "account_type", F.lit(None).cast("string").alias("name_normalized"), *columns[5:7], F.col("size_metric_unit").alias("unit_text"))
    # a measure's name is no unit: only what the tables don't read as one, and no unit at all, is a missing unit's text
    both = sites.unionByName(accounts).withColumn("unit_text", F.when(F.col("size_unit_name").isNotNull(), F.col("unit_text")))
    return materialize(both, "sizes")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose unit is stated: the tables of spellings decide alone, and what the model says of the others is p6_inferred."""
    sites = positive_amounts(site_sizes(spark, sf_dir), F.lit("staging_sites").alias("table_name"), record_key().alias("record_key"))
    accounts = positive_amounts(account_sizes(spark, sf_dir), F.lit("resolved_account").alias("table_name"), F.col("account_key").alias("record_key"))
    return sites.unionByName(accounts).select("table_name", "record_key", "measure", F.round(F.col("amount") * 100).cast("long").alias("amount_x100"))


def p6_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positive sizes without a stated unit, with the unit that the model gives them or their way to review."""
    return inferred_units(all_sizes(spark, sf_dir)).withColumn("confidence", F.round("confidence", 4))


def queries() -> dict:
    return {"p1_found": p1_found, "p2_found": p2_found, "p6_found": p6_found, "p6_inferred": p6_inferred}


def _p1_sql(table_name: str, key: str, texts: list[str], numbers: list[str], jsons: list[str]) -> str:
    text = [f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN ('', 'nan') THEN NULL ELSE {c} END" for c in texts]
    number = [f"CASE WHEN {c} IS NULL OR isnan({c}) THEN NULL ELSE CAST(round({c}, 6) + 0 AS VARCHAR) END" for c in numbers]
    members = "array_to_string(list_sort(list_filter(list_transform(json_keys({c}), lambda k: k || chr(2) || json_extract_string({c}, '$.\"' || k || '\"')), lambda x: x IS NOT NULL)), chr(3))"
    json = [f"CASE WHEN {c} IS NULL OR lower(trim({c})) IN ('', 'nan') THEN NULL ELSE {members.format(c=c)} END" for c in jsons]
    packed = " || chr(1) || ".join(f"coalesce({x}, chr(4))" for x in text + number + json)
    return f"""
    SELECT '{table_name}' AS table_name, record_key, snapshot_no, change_kind FROM (
      WITH cur AS (
        SELECT snapshot_no, vertical, {key} AS k, {packed} AS content
        FROM {table_name}
        QUALIFY row_number() OVER (PARTITION BY snapshot_no, {key} ORDER BY loaded_at DESC) = 1
      ), d AS (
        SELECT vertical, snapshot_no, lag(snapshot_no) OVER (PARTITION BY vertical ORDER BY snapshot_no) AS prev
        FROM (SELECT DISTINCT vertical, snapshot_no FROM cur)
      ), a AS (SELECT d.vertical, d.snapshot_no AS at, k, content FROM cur JOIN d ON cur.vertical = d.vertical AND cur.snapshot_no = d.snapshot_no WHERE prev IS NOT NULL),
      b AS (SELECT d.vertical, d.snapshot_no AS at, k, content FROM cur JOIN d ON cur.vertical = d.vertical AND cur.snapshot_no = d.prev)
      SELECT coalesce(a.k, b.k) AS record_key, coalesce(a.at, b.at) AS snapshot_no,
             CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
      FROM a FULL JOIN b ON a.vertical = b.vertical AND a.at = b.at AND a.k = b.k
      WHERE a.k IS NULL OR b.k IS NULL OR a.content <> b.content
    )"""


_P1 = (
    _p1_sql("resolved_account", "account_key", ["vertical", "account_type", "legal_name", "name_normalized", "dba_name", "parent_account_key", "phone", "email", "website", "status", "size_metric_unit"], ["size_metric", "confidence"], ["mailing_address", "external_keys"])
    + " UNION ALL "
    + _p1_sql("resolved_location", "location_key", ["account_key", "vertical", "location_name", "geocode_precision", "geometry_source", "acres_confidence", "site_type"], ["latitude", "longitude", "maintained_acres"], ["site_address"])
)


_P2 = """
WITH pos AS (
  SELECT source_id || ':' || natural_key AS k, latitude AS y, longitude AS x
  FROM (SELECT * FROM staging_sites QUALIFY row_number() OVER (PARTITION BY source_id, natural_key ORDER BY loaded_at DESC) = 1)
  WHERE latitude BETWEEN 24 AND 43 AND longitude BETWEEN -107 AND -74
), cell AS (SELECT *, CAST(floor(y * 500) AS BIGINT) AS cy, CAST(floor(x * 500) AS BIGINT) AS cx FROM pos),
near AS (
  SELECT a.k AS key_a, b.k AS key_b
  FROM (SELECT k, y, x, cy + dy AS cy, cx + dx AS cx FROM cell, (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx)) a
  JOIN cell b ON a.cy = b.cy AND a.cx = b.cx AND a.k < b.k
  WHERE 2 * 6371.0 * asin(sqrt(pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2))) <= 0.1
), part AS (
  SELECT natural_key AS region, unnest(polys) AS rings, generate_subscripts(polys, 1) AS part FROM (
    SELECT natural_key, CASE WHEN json_extract_string(boundary_geojson, '$.type') = 'Polygon' THEN [CAST(json_extract(boundary_geojson, '$.coordinates') AS DOUBLE[][][])]
      ELSE CAST(json_extract(boundary_geojson, '$.coordinates') AS DOUBLE[][][][]) END AS polys
    FROM gov_unit_boundary WHERE boundary_geojson IS NOT NULL)
), ring AS (SELECT region, part, unnest(rings) AS r FROM part),
edge AS (
  SELECT region, part, r[i][1] AS x1, r[i][2] AS y1, r[i + 1][1] AS x2, r[i + 1][2] AS y2
  FROM (SELECT region, part, r, unnest(range(1, len(r))) AS i FROM ring)
), box AS (SELECT region, part, min(least(x1, x2)) AS x0, max(greatest(x1, x2)) AS x9, min(least(y1, y2)) AS y0, max(greatest(y1, y2)) AS y9 FROM edge GROUP BY ALL),
cand AS (SELECT k, y, x, region, part FROM pos JOIN box ON x BETWEEN x0 AND x9 AND y BETWEEN y0 AND y9)
SELECT 'near' AS relation, key_a, key_b FROM near
UNION ALL
SELECT DISTINCT 'in', k, region FROM (
  SELECT k, region, part FROM cand JOIN edge USING (region, part)
  WHERE (y1 > y) <> (y2 > y) AND x < x1 + (y - y1) / (y2 - y1) * (x2 - x1)
  GROUP BY k, region, part HAVING count(*) % 2 = 1)
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": _P1, "p2_found": _P2}
