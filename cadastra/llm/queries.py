"""Queries of the training-data problems and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm.addresses import same_places
from cadastra.llm.components import connected_groups
from cadastra.llm.entities import matched_entities
from cadastra.llm.packing import packed, packing
from cadastra.llm.stuffing import stuffed_pages
from cadastra.llm.survivors import fused_values, surviving_records, usable_acres, usable_phone
from cadastra.llm.tokens import token_counts, token_ids
from cadastra.runtime import absent, latest_rows, record_key, table


def postal_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, address, city, state, zip5) of the current facilities and association certificates."""
    facilities = latest_rows(table(spark, sf_dir, "cms_general"), ["source_id", "natural_key"], columns=["address_line_1", "city", "state", "zip5", "loaded_at"])
    contacts = latest_rows(table(spark, sf_dir, "enrich_hoa_pdf_contact"), ["source_id", "natural_key"], "enriched_at", columns=["hoa_mailing_address", "enriched_at"])
    none = F.lit(None).cast("string")
    a = facilities.select(record_key().alias("key"), F.col("address_line_1").alias("address"), "city", "state", "zip5")
    b = contacts.select(record_key().alias("key"), F.col("hoa_mailing_address").alias("address"), none.alias("city"), none.alias("state"), none.alias("zip5"))
    return a.unionByName(b)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_places(postal_addresses(spark, sf_dir))


def stated_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(a, b) of every link between records; a run's cluster is a vertex of its own, marked by a blank in front."""
    pairs = table(spark, sf_dir, "pending_pairs").select(record_key("source_id_a", "natural_key_a").alias("a"), record_key("source_id_b", "natural_key_b").alias("b"), "status", "created_at", "pending_pair_id")
    latest = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max_by("status", F.struct("created_at", "pending_pair_id")).alias("status"))
    merged = latest.where("status = 'merged'").select("a", "b")
    runs = table(spark, sf_dir, "merge_run").select(record_key().alias("a"), "merged_sources", F.concat(F.lit(" "), F.col("run_id").cast("string"), F.lit("|"), F.col("cluster_id")).alias("cluster"), absent(F.col("cluster_id")).alias("no_cluster"))
    listed = runs.where(~absent(F.col("merged_sources"))).select("a", F.explode(F.split("merged_sources", ",")).alias("b")).select("a", F.trim("b").alias("b")).where(~absent(F.col("b")))
    clusters = runs.where(~F.col("no_cluster")).select("a", F.col("cluster").alias("b"))
    return merged.unionByName(listed).unionByName(clusters).where("a IS NOT NULL AND b IS NOT NULL")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = connected_groups(stated_links(spark, sf_dir)).where(~F.col("vertex").startswith(" "))
    # a cluster's vertex sorts before all records, so the group's key is taken anew over the records
    sizes = groups.groupBy("group").agg(F.min("vertex").alias("group_key"), F.count("*").alias("n")).where("n > 1")
    return groups.join(sizes, "group").select(F.col("vertex").alias("record_key"), "group_key")


def _facility_columns(df: DataFrame) -> DataFrame:
    rows = latest_rows(df, ["source_id", "natural_key"], columns=["name_raw", "name_normalized", "address_line_1", "city", "state", "zip5", "phone_raw", "phone_normalized", "latitude", "longitude", "ein", "loaded_at"])
    return rows.withColumn("key", record_key()).withColumnRenamed("address_line_1", "address").drop("source_id", "natural_key", "loaded_at")


def p5_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with their confidence."""
    facilities = _facility_columns(table(spark, sf_dir, "cms_general"))
    providers = _facility_columns(table(spark, sf_dir, "staging_sites").where("source_id = 'nppes_practice_locations'"))
    return matched_entities(facilities, providers).select(F.col("record").alias("rec_a"), F.col("query").alias("rec_b"), F.round("confidence", 6).alias("confidence"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_matches(spark, sf_dir).select("rec_a", "rec_b")


P7_FIELDS = {"acres_published": usable_acres, "maintained_acres": usable_acres, "phone": usable_phone}


def park_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest_rows(table(spark, sf_dir, "park_attrs"), ["source_id", "natural_key"], columns=["cluster_id", "acres_published", "maintained_acres", "phone", "loaded_at"])
    return rows.withColumn("record_key", record_key())


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {name: test(F.col(name)) for name, test in P7_FIELDS.items()}
    return surviving_records(park_members(spark, sf_dir), table(spark, sf_dir, "source_rank"), fields).select("cluster_id", "field_name", "record_key")


def p7_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fused values per group and field: acreages to one decimal, phones as their last ten digits. Trust ranks are the prior accuracies."""
    rows = park_members(spark, sf_dir)
    value = {"acres_published": F.round("acres_published", 1).cast("string"), "maintained_acres": F.round("maintained_acres", 1).cast("string"), "phone": F.right(F.regexp_replace("phone", "[^0-9]", ""), F.lit(10))}
    told = F.array(*[F.struct(F.lit(n).alias("field"), F.when(test(F.col(n)), value[n]).alias("value")) for n, test in P7_FIELDS.items()])
    claims = rows.select(F.col("cluster_id").alias("grp"), F.col("source_id").alias("source"), F.inline(told))
    ranks = table(spark, sf_dir, "source_rank").groupBy(F.col("source_id").alias("source")).agg(F.min("trust_rank").alias("rank"))
    out = fused_values(claims, priors=ranks.select("source", F.greatest(F.lit(0.55), 0.95 - 0.05 * F.col("rank")).alias("accuracy")))
    return out.select(F.col("grp").alias("cluster_id"), F.col("field").alias("field_name"), "value", F.round("probability", 6).alias("probability"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids(table(spark, sf_dir, "documents"))


def p9_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(token_counts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "container_spec"))


def p9_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins and lower bound of every partition and round of the packing."""
    return packing(token_counts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "container_spec"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffed_pages(table(spark, sf_dir, "documents")).select(F.col("doc").alias("doc_id"))


def queries() -> dict:
    return {"p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p5_matches": p5_matches, "p7_found": p7_found, "p7_fused": p7_fused, "p8_ids": p8_ids, "p9_packed": p9_packed, "p9_certificate": p9_certificate, "p10_found": p10_found}


_P4 = """
WITH RECURSIVE pair AS (
  SELECT a, b FROM (
    SELECT least(source_id_a || ':' || natural_key_a, source_id_b || ':' || natural_key_b) AS a, greatest(source_id_a || ':' || natural_key_a, source_id_b || ':' || natural_key_b) AS b, status, created_at, pending_pair_id
    FROM pending_pairs QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY created_at DESC, pending_pair_id DESC) = 1)
  WHERE status = 'merged'
), own AS (SELECT DISTINCT source_id || ':' || natural_key AS a, run_id, cluster_id, merged_sources FROM merge_run),
link AS (
  SELECT a, b FROM pair
  UNION SELECT a, trim(b) FROM (SELECT a, unnest(string_split(merged_sources, ',')) AS b FROM own WHERE lower(trim(merged_sources)) NOT IN ('', 'nan')) WHERE trim(b) <> ''
  UNION SELECT x.a, y.a FROM own x JOIN (SELECT run_id, cluster_id, min(a) AS a FROM own GROUP BY ALL) y ON x.run_id = y.run_id AND x.cluster_id = y.cluster_id
), arc AS (SELECT a, b FROM link WHERE a <> b UNION SELECT b, a FROM link WHERE a <> b),
reach AS (SELECT a, b FROM arc UNION SELECT r.a, arc.b FROM reach r JOIN arc ON r.b = arc.a)
SELECT a AS record_key, least(a, min(b)) AS group_key FROM reach GROUP BY a
"""

_P7 = """
WITH cur AS (
  SELECT source_id || ':' || natural_key AS record_key, p.*, coalesce(r.trust_rank, 2147483647) AS rnk
  FROM (SELECT * FROM park_attrs QUALIFY row_number() OVER (PARTITION BY source_id, natural_key ORDER BY loaded_at DESC) = 1) p
  LEFT JOIN source_rank r USING (source_id)
), big AS (SELECT * FROM cur WHERE cluster_id IN (SELECT cluster_id FROM cur GROUP BY 1 HAVING count(*) > 1)),
ok AS (
  SELECT cluster_id, 'acres_published' AS field_name, record_key, rnk, loaded_at FROM big WHERE acres_published > 0 AND NOT isnan(acres_published)
  UNION ALL SELECT cluster_id, 'maintained_acres', record_key, rnk, loaded_at FROM big WHERE maintained_acres > 0 AND NOT isnan(maintained_acres)
  UNION ALL SELECT cluster_id, 'phone', record_key, rnk, loaded_at FROM big
    WHERE length(regexp_replace(phone, '[^0-9]', '', 'g')) >= 10 AND len(list_distinct(string_split(regexp_replace(phone, '[^0-9]', '', 'g'), ''))) > 1
)
SELECT cluster_id, field_name, record_key FROM ok
QUALIFY row_number() OVER (PARTITION BY cluster_id, field_name ORDER BY rnk, loaded_at DESC, record_key) = 1
"""


def oracle_sql() -> dict[str, str]:
    return {"p4_found": _P4, "p7_found": _P7}
