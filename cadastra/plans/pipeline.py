"""Queries of routes, reports, resolved builders and served contacts over the records tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadastra.operators import core, polygons, reports, resolved, routes
from cadastra.plans.reference import ACCOUNT, CMS, LEV, PARKS, SITES, SNAP, ZIP, facilities, name, parks, present, reconciled, rectangles, sites, snapshot
from cadastra.plans.reference import RECONCILED, RECT
from cadastra.runtime import absent, latest_rows, materialize, record_key, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name_: str, sql: str | None = None):
    def add(f):
        QUERIES[name_] = f
        if sql:
            SQL[name_] = sql
        return f

    return add


# --- routes -------------------------------------------------------------------------------------------------------------

@query("cemetery_organizations", f"SELECT source_id, natural_key FROM {SITES} WHERE coalesce(left(ein, 2) = '13', FALSE) OR coalesce(starts_with(CASE WHEN starts_with(upper(name_raw), 'S') THEN 'Y50' ELSE 'X20' END, 'Y50'), FALSE)")
def cemetery_organizations(spark, sf_dir):
    activity = F.when(F.upper("name_raw").startswith("S"), "Y50").otherwise("X20")
    return sites(spark, sf_dir).where(routes.cemetery_organization(F.left("ein", F.lit(2)), activity)).select("source_id", "natural_key")


@query("facility_organizations", "SELECT p_partkey, coalesce(nullif(trim(p_type), ''), nullif(trim(p_brand), ''), '') AS first_code FROM part WHERE starts_with(p_type, 'SMALL') OR starts_with(p_brand, 'SMALL') OR starts_with(p_type, 'Brand#1') OR starts_with(p_brand, 'Brand#1')")
def facility_organizations(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    codes = [F.col(c) for c in ("p_type", "p_brand")]
    return p.where(routes.any_prefix(codes, ("SMALL", "Brand#1"))).select("p_partkey", routes.first_present([F.col("p_type"), F.col("p_brand")]).alias("first_code"))


@query("owner_locations", "SELECT o_orderkey, o_custkey, location_seq, CAST(o_custkey AS VARCHAR) || '|' || CAST(location_seq AS VARCHAR) AS natural_key FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS location_seq FROM orders) WHERE o_orderstatus = 'F'")
def owner_locations(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return routes.numbered_locations(o, "o_custkey", ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "location_seq", "natural_key")


RANKS = {"1-URGENT": "keep", "2-HIGH": "keep", "3-MEDIUM": "review"}


@query("rank_routes", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'keep' WHEN '2-HIGH' THEN 'keep' WHEN '3-MEDIUM' THEN 'review' ELSE 'unknown' END AS route FROM orders")
def rank_routes(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", routes.looked_up(F.col("o_orderpriority"), RANKS, "unknown").alias("route"))


@query("association_flags", r"SELECT DISTINCT natural_key, hoa_name, coalesce(regexp_matches(hoa_name, '(?i)ASSOCIATION|ASSN|ASSOC|CONDOMINIUM|\bCOA\b|\bHOA\b|OWNERS'), FALSE) AS is_association FROM enrich_hoa_pdf_contact")
def association_flags(spark, sf_dir):
    return table(spark, sf_dir, "enrich_hoa_pdf_contact").select("natural_key", "hoa_name", routes.association_name(F.col("hoa_name")).alias("is_association")).distinct()


@query("segments", f"SELECT source_id, natural_key, CASE WHEN contains(upper(coalesce(account_type, '')), 'RELIGIOUS') THEN 'religious' WHEN contains(upper(coalesce(account_type, '')), 'MUNICIPAL') OR upper(coalesce(segment, '')) = 'PUBLIC' THEN 'municipal' END AS inferred, coalesce(nullif(trim(segment), ''), CASE WHEN {present('ein')} THEN 'religious' WHEN source_id = 'va_cemeteries' THEN 'federal' ELSE 'municipal' END) AS segment FROM {SITES} WHERE vertical = 'deathcare'")
def segments(spark, sf_dir):
    s = sites(spark, sf_dir).where("vertical = 'deathcare'")
    return s.select("source_id", "natural_key", routes.segment_of(F.col("account_type"), F.col("segment")).alias("inferred"), routes.resolved_segment(F.col("segment"), ~absent(F.col("ein")), F.col("source_id") == "va_cemeteries").alias("segment"))


COUNTY = "CASE WHEN length(natural_key) % 3 = 0 THEN name_raw || ' / other' WHEN length(natural_key) % 3 = 1 THEN natural_key ELSE name_raw || ' and Next' END"


@query("county_parts", rf"SELECT natural_key, t IS NOT NULL AND NOT coalesce(regexp_full_match(t, '[0-9]+'), FALSE) AS usable, coalesce(regexp_matches(t, '[/&]|\bAND\b'), FALSE) AS several, CASE WHEN t IS NOT NULL AND NOT regexp_full_match(t, '[0-9]+') THEN trim(regexp_split_to_array(t, '[/&]|\bAND\b')[1]) END AS primary_county FROM (SELECT natural_key, upper(trim({COUNTY})) AS t FROM gov_unit_boundary)")
def county_parts(spark, sf_dir):
    return table(spark, sf_dir, "gov_unit_boundary").select("natural_key", routes.county_parts(F.expr(COUNTY)).alias("c")).select("natural_key", "c.usable", "c.several", F.col("c.primary").alias("primary_county"))


@query("encoded_urls", "SELECT DISTINCT natural_key, 'https://x.example' || array_to_string(list_transform(string_split('/docs/' || replace(hoa_name, '/', '-'), '/'), lambda p: url_encode(p)), '/') AS url FROM enrich_hoa_pdf_contact WHERE NOT regexp_matches(hoa_name, '[^A-Za-z0-9 #&.,-]')")
def encoded_urls(spark, sf_dir):
    t = table(spark, sf_dir, "enrich_hoa_pdf_contact").where(~F.col("hoa_name").rlike("[^A-Za-z0-9 #&.,-]"))
    return t.select("natural_key", routes.encoded_url(F.concat(F.lit("https://x.example/docs/"), F.replace("hoa_name", F.lit("/"), F.lit("-")))).alias("url")).distinct()


@query("queue_of_county", "SELECT source_id, natural_key FROM gov_unit_boundary WHERE coalesce(upper(trim(state)) = 'TX', FALSE)")
def queue_of_county(spark, sf_dir):
    return table(spark, sf_dir, "gov_unit_boundary").where(routes.in_county(F.col("state"), " tx ")).select("source_id", "natural_key")


@query("license_collapse", "SELECT l_orderkey, arg_min(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) AS l_suppkey, arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey)) AS l_returnflag, max(l_quantity) AS l_quantity, count(*) AS unit_rows FROM lineitem WHERE l_linestatus = 'F' AND l_quantity >= 20 GROUP BY 1")
def license_collapse(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    rows, _ = routes.funnel(l, {"open": F.col("l_linestatus") == "F", "sized": F.col("l_quantity") >= 20})
    return routes.collapsed(rows, "l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey"), "l_quantity", ["l_suppkey", "l_returnflag"])


@query("funnel_steps", "SELECT count(*) AS all_rows, count(*) FILTER (WHERE l_linestatus = 'F') AS open_rows, count(*) FILTER (WHERE l_linestatus = 'F' AND l_quantity >= 20) AS sized_rows FROM lineitem")
def funnel_steps(spark, sf_dir):
    return routes.funnel(table(spark, sf_dir, "lineitem"), {"open_rows": F.col("l_linestatus") == "F", "sized_rows": F.col("l_quantity") >= 20})[1]


# --- reports ------------------------------------------------------------------------------------------------------------

@query("source_runs", "SELECT user_id AS run, arg_max(event_type, (ts, event_type)) AS status, count(*) AS steps FROM events GROUP BY 1")
def source_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "run")
    return reports.run_log(e, "run", "event_type", "ts").join(e.groupBy("run").agg(F.count("*").alias("steps")), "run").select("run", "status", "steps")


NULLED = ["mgmt_phone", "mgmt_email", "website", "hoa_mailing_address"]


@query("null_counts", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE nullif(trim({c}), '') IS NULL) AS nulls FROM enrich_hoa_pdf_contact" for c in NULLED))
def null_counts(spark, sf_dir):
    return reports.null_counts(table(spark, sf_dir, "enrich_hoa_pdf_contact"), NULLED)


@query("acreage_summary", "SELECT source_id, count(*) AS n, count(v) AS filled, round(avg(v), 4) AS mean, round(median(v), 4) AS median FROM (SELECT source_id, CASE WHEN NOT isnan(acres_published) THEN acres_published END AS v FROM park_attrs) GROUP BY 1")
def acreage_summary(spark, sf_dir):
    return reports.numeric_summary(table(spark, sf_dir, "park_attrs"), "source_id", "acres_published")


@query("acreage_report", f"SELECT acres_confidence, count(*) AS n, round(coalesce(sum(acres), 0.0), 2) AS acres, count(*) FILTER (WHERE variance > 0.1) AS disagreeing FROM {RECONCILED} GROUP BY 1")
def acreage_report(spark, sf_dir):
    return reconciled(spark, sf_dir).groupBy("acres_confidence").agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum("acres"), F.lit(0.0)), 2).alias("acres"), F.count_if(F.col("variance") > 0.1).alias("disagreeing"))


@query("batch_exit_code", "SELECT count(*) FILTER (WHERE coalesce(enrich_status <> 'skipped', TRUE)) AS attempted, count(*) FILTER (WHERE enrich_status = 'error') AS failed, CASE WHEN count(*) FILTER (WHERE coalesce(enrich_status <> 'skipped', TRUE)) = count(*) FILTER (WHERE enrich_status = 'error') AND count(*) > 0 THEN 1 ELSE 0 END AS exit_code FROM enrich_hoa_pdf_contact")
def batch_exit_code(spark, sf_dir):
    return reports.all_failed(table(spark, sf_dir, "enrich_hoa_pdf_contact"), "enrich_status")


@query("merge_shares", "WITH c AS (SELECT coalesce(merge_confidence, 'unresolved') AS method, count(*) AS n FROM merge_run GROUP BY 1) SELECT method, n, round(n / CAST((SELECT sum(n) FROM c) AS DOUBLE), 6) AS share, method = 'unresolved' OR (method = 'spatial_only' AND n / CAST((SELECT sum(n) FROM c) AS DOUBLE) > 0.5) AS warning FROM c")
def merge_shares(spark, sf_dir):
    return reports.shares(table(spark, sf_dir, "merge_run"), "merge_confidence", "spatial_only")


@query("certificate_manifest", "SELECT natural_key, count(*) AS entries FROM enrich_hoa_pdf_contact GROUP BY 1")
def certificate_manifest(spark, sf_dir):
    return reports.manifest(table(spark, sf_dir, "enrich_hoa_pdf_contact"), "natural_key", ["certificate_id", "enrich_status"]).select("natural_key", "entries")


@query("raw_digests", """SELECT natural_key, sha256('{"natural_key":"' || natural_key || '","state":"' || coalesce(state, '') || '","geometry_sha":"' || sha256(coalesce(boundary_geojson, '')) || '"}') AS digest FROM gov_unit_boundary""")
def raw_digests(spark, sf_dir):
    return table(spark, sf_dir, "gov_unit_boundary").select("natural_key", reports.raw_digest(["natural_key", "state"], "boundary_geojson").alias("digest"))


# --- resolved tables ----------------------------------------------------------------------------------------------------

LAST = "row_number() OVER (PARTITION BY {k} ORDER BY loaded_at DESC, source_id DESC, natural_key DESC) = 1"


@query("resolved_accounts", f"SELECT {ACCOUNT} AS account_key, vertical, account_type, name_raw AS legal_name, {name('''coalesce(nullif(name_normalized, ''), name_raw)''')} AS name_normalized, CASE WHEN {present('phone_normalized')} THEN phone_normalized END AS phone, CASE WHEN NOT isnan(size_value) THEN size_value END AS size_metric, source_id, natural_key FROM {SITES} QUALIFY {LAST.format(k=ACCOUNT)}")
def resolved_accounts(spark, sf_dir):
    return resolved.accounts(sites(spark, sf_dir))


LOCATION = f"sha256('loc:' || {ACCOUNT} || '|' || {name('address_line_1')} || '|' || {ZIP.format(c='zip5')} || '|' || natural_key)"
BOTH = "latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)"


@query("resolved_locations", f"SELECT {LOCATION} AS location_key, {ACCOUNT} AS account_key, name_raw AS location_name, CASE WHEN {BOTH} THEN latitude END AS latitude, CASE WHEN {BOTH} THEN longitude END AS longitude, natural_key FROM {SITES} QUALIFY {LAST.format(k=LOCATION)}")
def resolved_locations(spark, sf_dir):
    return resolved.locations(sites(spark, sf_dir))


CONTACT = f"sha256('contact:' || {ACCOUNT} || '|primary_phone|' || {name('name_raw')})"


@query("resolved_contacts", f"SELECT {CONTACT} AS contact_key, {ACCOUNT} AS account_key, 'primary_phone' AS role, name_raw AS full_name, phone_normalized AS phone FROM {SITES} WHERE {present('phone_normalized')} QUALIFY {LAST.format(k=CONTACT)}")
def resolved_contacts(spark, sf_dir):
    return resolved.contacts(sites(spark, sf_dir))


S4, S5 = (SNAP.format(t="resolved_location", n=n, k="location_key") for n in (4, 5))
A4, A5 = (SNAP.format(t="resolved_account", n=n, k="account_key") for n in (4, 5))


@query("locations_with_owner", f"SELECT location_key, account_key, legal_name FROM {S5} JOIN (SELECT account_key, legal_name FROM {A5}) USING (account_key)")
def locations_with_owner(spark, sf_dir):
    l = snapshot(spark, sf_dir, "resolved_location", "location_key", 5, ["account_key"])
    a = snapshot(spark, sf_dir, "resolved_account", "account_key", 5, ["legal_name"])
    return resolved.with_owner(l, a, ["account_key"], ["legal_name"], F.col("loaded_at")).select("location_key", "account_key", "legal_name")


@query("parcel_overlay", f"WITH o AS (SELECT source_id, natural_key, arg_min(acres_published, (loaded_at, acres_published)) AS acres FROM park_attrs WHERE acres_published > 0 AND NOT isnan(acres_published) GROUP BY 1, 2) SELECT source_id, natural_key, coalesce(CASE WHEN NOT isnan(maintained_acres) THEN maintained_acres END, o.acres) AS acres FROM {PARKS} LEFT JOIN o USING (source_id, natural_key)")
def parcel_overlay(spark, sf_dir):
    own = parks(spark, sf_dir).select("source_id", "natural_key", F.when(~F.isnan("maintained_acres"), F.col("maintained_acres")).alias("acres"))
    p = table(spark, sf_dir, "park_attrs").where("acres_published > 0 AND NOT isnan(acres_published)")
    return resolved.overlaid(own, p.withColumn("acres", F.col("acres_published")), ["source_id", "natural_key"], ["acres"], F.struct("loaded_at", "acres_published"))


@query("uncovered_certificates", "WITH l AS (SELECT natural_key FROM enrich_hoa_pdf_contact QUALIFY row_number() OVER (PARTITION BY natural_key ORDER BY enriched_at DESC, coalesce(enrich_status, '') DESC) = 1 AND enrich_status = 'ok') SELECT DISTINCT natural_key FROM enrich_hoa_pdf_contact WHERE natural_key NOT IN (SELECT natural_key FROM l)")
def uncovered_certificates(spark, sf_dir):
    t = table(spark, sf_dir, "enrich_hoa_pdf_contact")
    good = F.coalesce(F.col("enrich_status") == "ok", F.lit(False))
    return resolved.uncovered(t.select("natural_key").distinct(), t, ["natural_key"], good, F.struct("enriched_at", F.coalesce("enrich_status", F.lit(""))))


@query("municipal_parks", f"SELECT source_id, natural_key FROM {PARKS} WHERE (source_id, natural_key) NOT IN (SELECT (source_id, natural_key) FROM {PARKS} WHERE ends_with(source_id, 'state_parks'))")
def municipal_parks(spark, sf_dir):
    p = parks(spark, sf_dir).select("source_id", "natural_key")
    return p.join(p.where(F.col("source_id").endswith("state_parks")), ["source_id", "natural_key"], "left_anti")


# --- served tables ------------------------------------------------------------------------------------------------------

def contacts_of(spark, sf_dir, n):
    a = snapshot(spark, sf_dir, "resolved_account", "account_key", n, ["phone", "email", "legal_name", "status"]).where(~absent(F.col("phone")))
    return a.select(F.concat("account_key", F.lit(":phone")).alias("contact_key"), "account_key", F.col("legal_name").alias("full_name"), "phone", "email", F.coalesce(F.col("status") != "inactive", F.lit(True)).alias("is_current"))


CONTACTS = f"(SELECT account_key || ':phone' AS contact_key, account_key, legal_name AS full_name, phone, email, coalesce(status <> 'inactive', TRUE) AS is_current FROM {{a}} WHERE {present('phone')})"
C4, C5 = CONTACTS.format(a=A4), CONTACTS.format(a=A5)


@query("diff_actions_contact", f"""SELECT contact_key, 'insert' AS action FROM {C5} WHERE account_key IN (SELECT account_key FROM {A4}) AND contact_key NOT IN (SELECT contact_key FROM {C4})
  UNION ALL SELECT r.contact_key, 'update' FROM {C5} r JOIN {C4} c USING (contact_key) WHERE md5(concat_ws('|', r.full_name, r.phone, r.email)) <> md5(concat_ws('|', c.full_name, c.phone, c.email))
  UNION ALL SELECT contact_key, 'retire' FROM {C4} WHERE is_current AND contact_key NOT IN (SELECT contact_key FROM {C5})""")
def diff_actions_contact(spark, sf_dir):
    new, old = contacts_of(spark, sf_dir, 5), contacts_of(spark, sf_dir, 4)
    served = snapshot(spark, sf_dir, "resolved_account", "account_key", 4, [])
    return core.contact_actions(new, old, served, ["full_name", "phone", "email"])


@query("stale_locations", f"SELECT location_key FROM {S4} WHERE location_key NOT IN (SELECT location_key FROM {S5}) AND account_key IN (SELECT account_key FROM {A4} WHERE status = 'active')")
def stale_locations(spark, sf_dir):
    new, old = (snapshot(spark, sf_dir, "resolved_location", "location_key", n, ["account_key"]) for n in (5, 4))
    served = snapshot(spark, sf_dir, "resolved_account", "account_key", 4, ["status"])
    return core.stale_locations(new, old, served, "active")  # the snapshots hold no tombstoned accounts, so active ones stand for them


@query("updated_status", f"SELECT account_key, CASE WHEN c.status = 'inactive' THEN 'inactive' ELSE r.status END AS status FROM {A5} r JOIN {A4} c USING (account_key)")
def updated_status(spark, sf_dir):
    new, old = (snapshot(spark, sf_dir, "resolved_account", "account_key", n, ["status"]) for n in (5, 4))
    return core.updated_status(new, old, gone_value="inactive")


@query("account_parents", f"SELECT account_key, parent_account_key, coalesce(parent_account_key IN (SELECT account_key FROM {A4}), FALSE) AS known FROM {A5}")
def account_parents(spark, sf_dir):
    new, old = (snapshot(spark, sf_dir, "resolved_account", "account_key", n, ["parent_account_key"]) for n in (5, 4))
    return core.with_parent(new, old)


# --- parks --------------------------------------------------------------------------------------------------------------

SOURCES = {0: "padus_parks", 1: "state_parks", 2: "local_parks"}
_PARKED = f"(SELECT *, CASE k % 3 WHEN 0 THEN 'padus_parks' WHEN 1 THEN 'state_parks' ELSE 'local_parks' END AS source_id, 'PARK ' || CAST((k - k % 3) % 50 AS VARCHAR) AS n, CASE WHEN k % 2 = 0 THEN 'M' || k END AS manager FROM {RECT})"


@query("merged_parks", f"""WITH RECURSIVE p AS MATERIALIZED {_PARKED}, i AS (SELECT a.k AS a, b.k AS b, a.n AS na, b.n AS nb, (least(a.x0 + a.w, b.x0 + b.w) - greatest(a.x0, b.x0)) * (least(a.y0 + a.h, b.y0 + b.h) - greatest(a.y0, b.y0)) AS common, a.w * a.h + b.w * b.h AS sum_area
    FROM p a JOIN p b ON a.k < b.k AND a.source_id <> b.source_id AND a.x0 < b.x0 + b.w AND b.x0 < a.x0 + a.w AND a.y0 < b.y0 + b.h AND b.y0 < a.y0 + a.h),
  l AS (SELECT a, b, common / (sum_area - common) AS iou FROM i WHERE common / (sum_area - common) > 0.6 + 1e-9 AND ({LEV}) > 0.5), arc AS (SELECT a, b FROM l UNION SELECT b, a FROM l UNION SELECT k, k FROM p),
  reach AS (SELECT a, b FROM arc UNION SELECT r.a, arc.b FROM reach r JOIN arc ON r.b = arc.a), g AS (SELECT a AS k, min(b) AS cluster FROM reach GROUP BY 1),
  best AS (SELECT k, max(iou) AS best FROM (SELECT a AS k, iou FROM l UNION ALL SELECT b, iou FROM l) GROUP BY 1),
  m AS (SELECT g.cluster, p.*, best, CASE source_id WHEN 'padus_parks' THEN 10 WHEN 'state_parks' THEN 20 ELSE 30 END AS r, CAST(p.k AS VARCHAR) AS natural_key FROM g JOIN p USING (k) LEFT JOIN best USING (k))
  SELECT arg_min(source_id, (r, natural_key)) AS source_id, arg_min(natural_key, (r, natural_key)) AS natural_key, arg_min(manager, (r, natural_key)) FILTER (WHERE manager IS NOT NULL) AS manager, string_agg(CAST(k AS VARCHAR), ',' ORDER BY r, natural_key) AS merged_sources,
    round((arg_min({{'b': best}}, (r, natural_key))).b, 5) AS merge_iou FROM m GROUP BY cluster""")
def merged_parks(spark, sf_dir):
    r = rectangles(spark, sf_dir)
    third = F.pmod(F.col("key"), F.lit(3))
    rows = r.select("key", routes.looked_up(third.cast("string"), {str(k): v for k, v in SOURCES.items()}).alias("source_id"), F.col("key").cast("string").alias("natural_key"), F.concat(F.lit("PARK "), (F.pmod(F.col("key") - third, F.lit(50))).cast("string")).alias("name_normalized"), F.when(F.col("key") % 2 == 0, F.concat(F.lit("M"), F.col("key").cast("string"))).alias("manager"))
    pairs = materialize(polygons.overlap_pairs(r, r, same=True, over=0.6 + 1e-9), "pairs")
    out = polygons.merged_parks(rows, pairs, {"padus_parks": 10, "state_parks": 20, "local_parks": 30}, ["manager"])
    return out.select("source_id", "natural_key", "manager", "merged_sources", F.round("merge_iou", 5).alias("merge_iou"))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
