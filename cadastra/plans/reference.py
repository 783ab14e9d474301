"""Queries of the linkage, survivorship, diff, spatial and quality operators over the records tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.functions import keys as K
from cadastra.functions import text as X
from cadastra.functions.certificates import certificate_fields as parse_fields
from cadastra.functions.geo import haversine_km
from cadastra.functions.many import compound_of, trigrams_of
from cadastra.functions.similarity import jaro_winkler, name_similarity
from cadastra.operators import core, enrichment, keyed, linkage, managers, polygons, quality, spatial
from cadastra.operators.blocked import compared_pairs
from cadastra.runtime import absent, absent_number, latest_rows, materialize, record_key, spread, table

SITE_COLUMNS = ["source_id", "natural_key", "vertical", "account_type", "name_raw", "name_normalized", "address_line_1", "city", "state", "zip5", "phone_raw", "phone_normalized", "latitude", "longitude", "segment", "ein", "size_value", "loaded_at"]
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(table(spark, sf_dir, "staging_sites"), ["source_id", "natural_key"], columns=SITE_COLUMNS)


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(table(spark, sf_dir, "cms_general"), ["source_id", "natural_key"], columns=SITE_COLUMNS)


def healthcare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facilities(spark, sf_dir).unionByName(sites(spark, sf_dir).where("vertical = 'healthcare'"))


# Shared SQL: current rows, and the normalizers as macros written out
CUR = "(SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY source_id, natural_key ORDER BY loaded_at DESC) = 1)"
SITES, CMS = CUR.format(t="staging_sites"), CUR.format(t="cms_general")
HEALTH = f"(SELECT {', '.join(SITE_COLUMNS)} FROM {CMS} UNION ALL SELECT {', '.join(SITE_COLUMNS)} FROM {SITES} WHERE vertical = 'healthcare')"
NAME = r"trim(regexp_replace(regexp_replace(regexp_replace(upper(coalesce({c}, '')), '\b(INC|LLC|LTD|CORP|CO|PLC|LP|LLP|ASSN|ASSOC|ASSOCIATION)\b', ' ', 'g'), '[^A-Z0-9 ]', ' ', 'g'), '\s+', ' ', 'g'))"
DIGITS = "regexp_replace(coalesce({c}, ''), '[^0-9]', '', 'g')"
ZIP = f"CASE WHEN length({DIGITS}) >= 5 THEN left({DIGITS}, 5) ELSE '' END"
PHONE = f"CASE WHEN length({DIGITS}) >= 10 THEN {DIGITS} ELSE '' END"
PRESENT = "({c} IS NOT NULL AND lower(trim({c})) NOT IN ('', 'nan'))"
HAVERSINE = "2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.latitude - {a}.latitude) / 2), 2) + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2))))"


def name(c: str) -> str:
    return NAME.format(c=c)


def present(c: str) -> str:
    return PRESENT.format(c=c)


# --- scalar functions ---------------------------------------------------------------------------------------------

@query("normalize_name_parts", f"SELECT source_id, natural_key, {name('name_raw')} AS name_norm, {ZIP.format(c='zip5')} AS zip_norm, {PHONE.format(c='phone_raw')} AS phone_norm FROM {SITES}")
def normalize_name_parts(spark, sf_dir):
    return sites(spark, sf_dir).select("source_id", "natural_key", X.normalize_name(F.col("name_raw")).alias("name_norm"), X.normalize_zip(F.col("zip5")).alias("zip_norm"), X.normalize_phone(F.col("phone_raw")).alias("phone_norm"))


@query("int_key_cast", "SELECT source_id, natural_key, coalesce(CAST(CAST(trunc(TRY_CAST(zip5 AS DOUBLE)) AS BIGINT) AS VARCHAR), '') AS zip_int, CASE WHEN TRY_CAST(zip5 AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(zip5 AS DOUBLE)) THEN 1 ELSE 0 END AS is_number FROM (SELECT source_id, natural_key, CASE WHEN lower(trim(zip5)) = 'nan' THEN NULL ELSE zip5 END AS zip5 FROM " + SITES + ")")
def int_key_cast(spark, sf_dir):
    z = F.when(F.lower(F.trim("zip5")) != "nan", F.col("zip5"))
    return sites(spark, sf_dir).select("source_id", "natural_key", X.int_key(z).alias("zip_int"), F.when(z.try_cast("double").isNotNull(), 1).otherwise(0).alias("is_number"))


@query("url_id_extract", r"SELECT DISTINCT natural_key, nullif(regexp_extract(certificate_url, '/certificates/[0-9]+/([^/]+)/([^/]+)/', 1), '') AS certificate_id, nullif(regexp_extract(certificate_url, '/certificates/[0-9]+/([^/]+)/([^/]+)/', 2), '') AS kind FROM enrich_hoa_pdf_contact")
def url_id_extract(spark, sf_dir):
    return table(spark, sf_dir, "enrich_hoa_pdf_contact").select("natural_key", X.certificate_ids(F.col("certificate_url")).alias("c")).select("natural_key", "c.*").distinct()


PACKED = "concat_ws(', ', address_line_1, city, state || ' ' || left(zip5, 5))"


@query("packed_address_parse", rf"""SELECT natural_key, regexp_extract(trim(p), '([0-9]{{5}})$', 1) AS zip, regexp_extract(trim(p), '\b([A-Z]{{2}})\s+[0-9]{{5}}$', 1) AS st,
  trim(list_last(string_split(q, ','))) AS town, array_to_string(list_transform(CASE WHEN len(string_split(q, ',')) <= 1 THEN string_split(q, ',') ELSE string_split(q, ',')[:-2] END, lambda x: trim(x)), ', ') AS street
  FROM (SELECT natural_key, p, regexp_replace(regexp_replace(trim(p), '\b[A-Z]{{2}}\s+[0-9]{{5}}$', ''), '[ ,]+$', '') AS q FROM (SELECT natural_key, {PACKED} AS p FROM {CMS}))""")
def packed_address_parse(spark, sf_dir):
    p = F.concat_ws(", ", "address_line_1", "city", F.concat("state", F.lit(" "), F.left("zip5", F.lit(5))))
    return facilities(spark, sf_dir).select("natural_key", X.packed_zip(p).alias("zip"), X.packed_state(p).alias("st"), X.packed_city(p).alias("town"), X.packed_street(p).alias("street"))


@query("area_units", "SELECT natural_key, round(size_value / 43560.0, 6) AS from_sqft, round(size_value / 4046.856, 6) AS from_sqm, round(size_value / 4046.8564224, 6) AS from_sqm_exact FROM " + SITES + " WHERE size_value > 0 AND NOT isnan(size_value)")
def area_units(spark, sf_dir):
    v = F.col("size_value")
    return sites(spark, sf_dir).where((v > 0) & ~F.isnan(v)).select("natural_key", F.round(v / 43560.0, 6).alias("from_sqft"), F.round(v / 4046.856, 6).alias("from_sqm"), F.round(v / 4046.8564224, 6).alias("from_sqm_exact"))


@query("fips_state_map", "SELECT state, CASE state WHEN 'FL' THEN '12' WHEN 'NC' THEN '37' WHEN 'SC' THEN '45' WHEN 'TX' THEN '48' WHEN 'PA' THEN '42' END AS fips, count(*) AS n FROM gov_unit_boundary GROUP BY 1, 2")
def fips_state_map(spark, sf_dir):
    return table(spark, sf_dir, "gov_unit_boundary").groupBy("state").agg(F.count("*").alias("n")).select("state", X.fips_of(F.col("state")).alias("fips"), "n")


@query("json_address", "SELECT natural_key, CASE WHEN " + present("address_line_1") + " THEN address_line_1 END AS line1, CASE WHEN " + present("city") + " THEN city END AS town, CASE WHEN " + present("zip5") + " THEN zip5 END AS zip FROM " + CMS)
def json_address(spark, sf_dir):
    some = lambda c: F.when(~absent(F.col(c)), F.col(c))
    text = F.to_json(F.struct(some("address_line_1").alias("line1"), some("city").alias("town"), some("zip5").alias("zip")))
    return facilities(spark, sf_dir).select("natural_key", F.from_json(text, "line1 string, town string, zip string").alias("j")).select("natural_key", "j.*")


@query("document_contacts", r"SELECT doc_id, nullif(regexp_extract(text, '(?i)([A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,})', 1), '') AS email, length(text) - length(replace(text, '@', '')) AS at_signs FROM documents")
def document_contacts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.first_email(F.col("text")).alias("email"), (F.length("text") - F.length(F.replace("text", F.lit("@"), F.lit("")))).alias("at_signs"))


@query("mailto_emails", r"""SELECT natural_key, list_distinct(list_transform(regexp_extract_all(html, '(?i)href\s*=\s*["'']mailto:([^"''?]+)', 1), lambda e: lower(trim(e))))[1] AS email FROM (SELECT natural_key, '<a href="mailto:' || mgmt_email || '?subject=x">mail</a>' AS html FROM enrich_hoa_pdf_contact WHERE mgmt_email IS NOT NULL) WHERE lower(html) NOT LIKE '%mailto:noreply@%' AND lower(html) NOT LIKE '%mailto:donotreply@%'""")
def mailto_emails(spark, sf_dir):
    t = table(spark, sf_dir, "enrich_hoa_pdf_contact").where("mgmt_email IS NOT NULL")
    html = F.concat(F.lit('<a href="mailto:'), F.col("mgmt_email"), F.lit('?subject=x">mail</a>'))
    return t.select("natural_key", F.get(X.mailto_emails(html), F.lit(0)).alias("email")).where("email IS NOT NULL")


# --- pairs --------------------------------------------------------------------------------------------------------

def _pairs_sql() -> str:
    """Facilities and provider rows of each of the reference's three blocks, a pair of several blocks once."""
    side = f"SELECT natural_key, {name('name_raw')} AS n, address_line_1 AS s, latitude AS la, longitude AS lo, phone_normalized AS p, coalesce(state, '') AS st, {ZIP.format(c='zip5')} AS z, left(coalesce(name_normalized, ''), 4) AS pre, {PHONE.format(c='phone_normalized')} AS ph, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude) THEN floor(latitude)::VARCHAR || ',' || floor(longitude)::VARCHAR END AS cell FROM "
    blocks = ["a.st = b.st AND a.z = b.z AND a.pre = b.pre", "a.st = b.st AND a.ph = b.ph AND a.ph <> ''", "a.cell = b.cell"]
    pick = "a.natural_key AS key_a, b.natural_key AS key_b, a.n AS na, b.n AS nb, a.s AS sa, b.s AS sb, a.la, b.la AS lb, a.lo AS oa, b.lo AS ob, a.p AS pa, b.p AS pb"
    a, b = f"({side}{CMS})", f"({side}{SITES} WHERE source_id = 'nppes_practice_locations')"
    return "(" + " UNION ".join(f"SELECT {pick} FROM {a} a JOIN {b} b ON {on}" for on in blocks) + ")"


PAIRS = _pairs_sql()


def pair_blocks() -> list:
    """Keys of the reference's blocks: state, zip and name prefix, state and phone, a 1-degree cell."""
    phone, state = X.normalize_phone(F.col("phone_normalized")), F.coalesce("state", F.lit(""))
    placed = ~absent_number(F.col("latitude")) & ~absent_number(F.col("longitude"))
    return [
        F.concat_ws(":", F.lit("szn"), state, X.normalize_zip(F.col("zip5")), F.left(F.coalesce("name_normalized", F.lit("")), F.lit(4))),
        F.when(phone != "", F.concat_ws(":", F.lit("sph"), state, phone)),
        F.when(placed, F.concat_ws(":", F.lit("geo"), F.floor("latitude").cast("string"), F.floor("longitude").cast("string"))),
    ]


def pairs(spark, sf_dir):
    """Facilities and provider rows that share one of the reference's blocks: state, zip and name prefix, state and phone, or a 1-degree cell; each pair once."""
    def side(df, x):
        cols = [F.col("natural_key").alias("key_" + x), X.normalize_name(F.col("name_raw")).alias("n" + x), F.col("address_line_1").alias("s" + x), F.col("latitude").alias("l" + x), F.col("longitude").alias("o" + x), F.col("phone_normalized").alias("p" + x)]
        return df.select(*cols, F.filter(F.array(*pair_blocks()), lambda k: k.isNotNull()).alias("blocks_" + x))

    a = side(facilities(spark, sf_dir), "a").withColumn("block", F.explode("blocks_a"))
    b = side(sites(spark, sf_dir).where("source_id = 'nppes_practice_locations'"), "b").withColumn("block", F.explode("blocks_b"))
    # a pair of several blocks is taken from the first they share
    return a.join(b, "block").where(F.get(F.array_intersect("blocks_a", "blocks_b"), F.lit(0)) == F.col("block")).drop("block", "blocks_a", "blocks_b")


def name_pairs(spark, sf_dir, similarity) -> DataFrame:
    """(key_a, key_b, sim) of the names of pairs(), compared by parts of blocks."""
    blocks = ["szn", "sph", "geo"]
    side = lambda df: df.select(F.col("natural_key").alias("key"), X.normalize_name(F.col("name_raw")).alias("text"), *[k.alias(c) for k, c in zip(pair_blocks(), blocks)])
    found = compared_pairs(side(facilities(spark, sf_dir)), side(sites(spark, sf_dir).where("source_id = 'nppes_practice_locations'")), blocks, similarity)
    return found.withColumn("sim", F.round("sim", 6))


LEV = "CASE WHEN trim(na) = '' OR trim(nb) = '' THEN 0.0 ELSE 1 - levenshtein(na, nb) / CAST(greatest(length(na), length(nb)) AS DOUBLE) END"
JW = "CASE WHEN na = '' OR nb = '' THEN 0.0 ELSE jaro_winkler_similarity(na, nb) END"
GRAMS = "list_transform(range(1, length({c}) - 1), lambda i: substring({c}, i, 3))"
TRI = f"CASE WHEN length(na) < 3 OR length(nb) < 3 THEN 0.0 ELSE list_sum(list_transform(list_distinct(list_intersect({GRAMS.format(c='na')}, {GRAMS.format(c='nb')})), lambda g: least(len(list_filter({GRAMS.format(c='na')}, lambda v: v = g)), len(list_filter({GRAMS.format(c='nb')}, lambda v: v = g))))) / CAST(greatest(length(na), length(nb)) - 2 AS DOUBLE) END"


@query("name_similarity_pairs", f"SELECT key_a, key_b, round({LEV}, 6) AS sim FROM {PAIRS}")
def name_similarity_pairs(spark, sf_dir):
    return pairs(spark, sf_dir).select("key_a", "key_b", F.round(name_similarity(F.col("na"), F.col("nb")), 6).alias("sim"))


@query("jaro_winkler_pairs", f"SELECT key_a, key_b, round({JW}, 6) AS sim FROM {PAIRS}")
def jaro_winkler_pairs(spark, sf_dir):
    return pairs(spark, sf_dir).select("key_a", "key_b", F.round(jaro_winkler(F.col("na"), F.col("nb")), 6).alias("sim"))


@query("trigram_pairs", f"SELECT key_a, key_b, round(coalesce({TRI}, 0.0), 6) AS sim FROM {PAIRS}")
def trigram_pairs(spark, sf_dir):
    return name_pairs(spark, sf_dir, trigrams_of)


@query("compound_pairs", f"SELECT key_a, key_b, round(0.6 * ({JW}) + 0.4 * coalesce({TRI}, 0.0), 6) AS sim FROM {PAIRS}")
def compound_pairs(spark, sf_dir):
    return name_pairs(spark, sf_dir, compound_of)


@query("haversine_pairs", f"SELECT key_a, key_b, round({HAVERSINE.format(a='a', b='b')}, 6) AS km FROM (SELECT key_a, key_b, {{'latitude': la, 'longitude': oa}} AS a, {{'latitude': lb, 'longitude': ob}} AS b FROM {PAIRS} WHERE la IS NOT NULL AND lb IS NOT NULL AND oa IS NOT NULL AND ob IS NOT NULL AND NOT isnan(la) AND NOT isnan(lb) AND NOT isnan(oa) AND NOT isnan(ob))")
def haversine_pairs(spark, sf_dir):
    p = pairs(spark, sf_dir)
    for c in ("la", "oa", "lb", "ob"):
        p = p.where(~absent_number(F.col(c)))
    return p.select("key_a", "key_b", F.round(haversine_km(F.col("la"), F.col("oa"), F.col("lb"), F.col("ob")), 6).alias("km"))


# --- keys ---------------------------------------------------------------------------------------------------------

ACCOUNT = f"sha256(CASE WHEN {present('ein')} THEN 'ein:' || trim(ein) ELSE 'name:' || {name('''coalesce(nullif(name_normalized, ''), name_raw, '')''')} || '|zip:' || {ZIP.format(c='zip5')} END)"


@query("account_keys", f"SELECT source_id, natural_key, {ACCOUNT} AS account_key FROM {SITES}")
def account_keys(spark, sf_dir):
    s = sites(spark, sf_dir)
    return s.select("source_id", "natural_key", K.account_key(s, K.KeySpec(("ein",))).alias("account_key"))


@query("location_keys_discriminated", f"SELECT source_id, natural_key, sha256('loc:' || account || '|' || {name('address_line_1')} || '|' || {ZIP.format(c='zip5')} || '|' || natural_key) AS location_key FROM (SELECT *, {ACCOUNT} AS account FROM {SITES})")
def location_keys_discriminated(spark, sf_dir):
    s = sites(spark, sf_dir)
    return s.select("source_id", "natural_key", K.location_key(K.account_key(s, K.KeySpec(("ein",))), F.col("address_line_1"), F.col("zip5"), discriminator=F.col("natural_key")).alias("location_key"))


@query("contact_keys", f"SELECT source_id, natural_key, sha256('contact:' || account || '|primary_phone|' || {name('name_raw')}) AS contact_key FROM (SELECT *, {ACCOUNT} AS account FROM {SITES}) WHERE {present('phone_normalized')}")
def contact_keys(spark, sf_dir):
    s = sites(spark, sf_dir)
    return s.where(~absent(F.col("phone_normalized"))).select("source_id", "natural_key", K.contact_key(K.account_key(s, K.KeySpec(("ein",))), F.lit("primary_phone"), F.col("name_raw")).alias("contact_key"))


HASHED = ["vertical", "account_type", "legal_name", "name_normalized", "dba_name", "parent_account_key", "phone", "email", "website", "status", "size_metric_unit"]
SNAP = "(SELECT * FROM {t} WHERE snapshot_no = {n} QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY loaded_at DESC) = 1)"


def snapshot(spark, sf_dir, name, key, n, columns):
    return latest_rows(table(spark, sf_dir, name).where(f"snapshot_no = {n}"), [key], columns=[*columns, "loaded_at"])


@query("content_hash_account", f"SELECT account_key, md5(concat_ws('|', {', '.join(HASHED)})) AS h FROM {SNAP.format(t='resolved_account', n=5, k='account_key')}")
def content_hash_account(spark, sf_dir):
    return snapshot(spark, sf_dir, "resolved_account", "account_key", 5, HASHED).select("account_key", K.content_hash([F.col(c) for c in HASHED]).alias("h"))


# --- tiers, components, survivorship --------------------------------------------------------------------------------

RECORD = "source_id || ':' || natural_key"


def tiers(spark, sf_dir):
    h = healthcare(spark, sf_dir)
    h = h.select("*", X.normalize_name(F.coalesce(F.nullif("name_normalized", F.lit("")), F.col("name_raw"))).alias("name"), X.normalize_zip(F.col("zip5")).alias("zip"))
    return linkage.tier2(h.withColumn("cluster_id", linkage.tier1(h)), "name", "zip", "state")


TIERS = f"""(SELECT *, CASE WHEN name NOT IN ('HCA HEALTHCARE', 'ASCENSION HEALTH', 'COMMONSPIRIT HEALTH', 'ADVENT HEALTH', 'TENET HEALTHCARE', 'COMMUNITY HEALTH SYSTEMS') AND count(*) OVER (PARTITION BY name, zip, coalesce(state, '')) > 1
  THEN 't2:' || name || '|' || zip || '|' || coalesce(state, '') ELSE 'src:' || {RECORD} END AS cluster_id
  FROM (SELECT *, {name("coalesce(nullif(name_normalized, ''), name_raw)")} AS name, {ZIP.format(c='zip5')} AS zip FROM {HEALTH}))"""


@query("tier1_ids", f"SELECT source_id, natural_key, CASE WHEN {present('ein')} THEN 'ein:' || trim(ein) ELSE 'src:' || {RECORD} END AS cluster_id FROM {HEALTH}")
def tier1_ids(spark, sf_dir):
    h = healthcare(spark, sf_dir)
    return h.select("source_id", "natural_key", linkage.tier1(h, ("ein",)).alias("cluster_id"))


@query("tier2_exact", f"SELECT source_id, natural_key, cluster_id FROM {TIERS}")
def tier2_exact(spark, sf_dir):
    return tiers(spark, sf_dir).select("source_id", "natural_key", "cluster_id")


def fuzzy(spark, sf_dir):
    clean = lambda c: F.when(~absent_number(F.col(c)), F.col(c)).alias(c)
    rows = tiers(spark, sf_dir).where(F.col("cluster_id").startswith("src:")).select(record_key().alias("id"), "name", F.col("address_line_1").alias("address"), F.col("phone_normalized").alias("phone"), "state", F.col("zip5"), clean("latitude"), clean("longitude"), clean("size_value"))
    return linkage.fuzzy_pairs(materialize(rows, "unmerged"))


def _tier3_sql() -> str:
    """Pairs of unmerged rows that share one of the three blocks, with their score."""
    finite = lambda c: f"CASE WHEN {c} IS NOT NULL AND NOT isnan({c}) THEN {c} END AS {c}"
    rows = f"SELECT {RECORD} AS id, name AS n, {name('address_line_1')} AS s, {PHONE.format(c='phone_normalized')} AS p, coalesce(state, '') AS st, {ZIP.format(c='zip5')} AS z, left(name, 4) AS pre, {finite('latitude')}, {finite('longitude')}, {finite('size_value')} FROM {TIERS} WHERE cluster_id LIKE 'src:%'"
    blocks = ["a.st = b.st AND a.z = b.z AND a.pre = b.pre", "a.st = b.st AND a.p = b.p AND a.p <> ''", "floor(a.latitude) = floor(b.latitude) AND floor(a.longitude) = floor(b.longitude)"]
    alike = lambda c: f"(SELECT 0.6 * ({JW}) + 0.4 * coalesce({TRI}, 0.0) FROM (SELECT a.{c} AS na, b.{c} AS nb))"
    km = HAVERSINE.format(a="a", b="b")
    larger = "greatest(a.size_value, b.size_value)"
    score = f"""0.35 * {alike('n')} + 0.3 * {alike('s')} + (0.2 * coalesce(greatest(0.0, 1 - ({km}) / 0.5), 0.0) + 0.1 * CASE WHEN a.p <> '' AND a.p = b.p THEN 1.0 ELSE 0.0 END
      + 0.05 * CASE WHEN a.size_value IS NULL OR b.size_value IS NULL OR {larger} = 0 THEN 0.0 WHEN abs(a.size_value - b.size_value) / {larger} < 0.2 THEN 1.0 ELSE 0.0 END)"""
    pairs_ = " UNION ".join(f"SELECT a.id AS x, b.id AS y FROM r a JOIN r b ON a.id < b.id AND {on}" for on in blocks)
    return f"WITH r AS MATERIALIZED ({rows}), q AS ({pairs_}) SELECT a.id AS a_id, b.id AS b_id, CAST({score} AS DOUBLE) AS score FROM q JOIN r a ON a.id = q.x JOIN r b ON b.id = q.y"


_T3 = _tier3_sql()


@query("tier3_review_band", f"SELECT a_id, b_id, round(score, 6) AS score FROM ({_T3}) WHERE score >= 0.75 AND score < 0.92")
def tier3_review_band(spark, sf_dir):
    return fuzzy(spark, sf_dir).where("score < 0.92").select("a_id", "b_id", F.round("score", 6).alias("score"))


@query("tier3_auto_clusters", f"""WITH RECURSIVE u AS MATERIALIZED (SELECT {RECORD} AS k, natural_key FROM {TIERS} WHERE cluster_id LIKE 'src:%'), l AS (SELECT a_id AS a, b_id AS b FROM ({_T3}) WHERE score >= 0.92), arc AS (SELECT a, b FROM l UNION SELECT b, a FROM l UNION SELECT k, k FROM u),
  reach AS (SELECT a, b FROM arc UNION SELECT r.a, arc.b FROM reach r JOIN arc ON r.b = arc.a) SELECT a AS record_key, 't3:' || min(natural_key) AS cluster_id FROM reach JOIN u ON b = k GROUP BY a""")
def tier3_auto_clusters(spark, sf_dir):
    rows = tiers(spark, sf_dir).where(F.col("cluster_id").startswith("src:")).select(record_key().alias("id"), "natural_key")
    return linkage.tier3(rows, fuzzy(spark, sf_dir).where("score >= 0.92")).withColumnRenamed("id", "record_key")


@query("merge_all_survivors", f"""WITH t AS (SELECT *, CASE source_id WHEN 'cms_general' THEN 0 ELSE 1 END AS r FROM {TIERS}),
  n AS (SELECT cluster_id, count(*) AS members FROM t GROUP BY 1),
  pick AS (SELECT cluster_id, {', '.join(f"arg_min({c}, (r, natural_key)) FILTER (WHERE {present(c)}) AS {c}" for c in ('name_raw', 'address_line_1', 'city', 'zip5', 'phone_normalized', 'ein'))},
    arg_min(latitude, (r, natural_key)) FILTER (WHERE latitude IS NOT NULL AND NOT isnan(latitude)) AS latitude,
    string_agg({RECORD}, ',' ORDER BY r, natural_key) AS merged_sources FROM t GROUP BY 1)
  SELECT pick.*, members FROM pick JOIN n USING (cluster_id)""")
def merge_all_survivors(spark, sf_dir):
    rank = F.when(F.col("source_id") == "cms_general", 0).otherwise(1)
    out = linkage.survivors(tiers(spark, sf_dir), "cluster_id", ["name_raw", "address_line_1", "city", "zip5", "phone_normalized", "ein"], rank, F.col("natural_key"), record_key())
    return out.drop("longitude")


CEMETERIES = f"(SELECT {RECORD} AS k, source_id, natural_key, name_normalized, latitude, longitude, ein FROM {SITES} WHERE vertical = 'deathcare' AND latitude BETWEEN 24 AND 43 AND longitude BETWEEN -107 AND -74)"


def cemetery_links(spark, sf_dir, km=0.15):
    s = sites(spark, sf_dir).where("vertical = 'deathcare' AND latitude BETWEEN 24 AND 43 AND longitude BETWEEN -107 AND -74")
    return spatial.near_pairs(s.select(record_key().alias("key"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon")), km)


CELL = "CAST(floor({y} / 0.002) AS BIGINT)"
NEAR = f"""(SELECT a.k AS a, b.k AS b FROM (SELECT *, {CELL.format(y='latitude')} + dy AS cy, {CELL.format(y='longitude')} + dx AS cx FROM {CEMETERIES}, (SELECT unnest([-1, 0, 1]) AS dy), (SELECT unnest([-1, 0, 1]) AS dx)) a
  JOIN (SELECT *, {CELL.format(y='latitude')} AS cy, {CELL.format(y='longitude')} AS cx FROM {CEMETERIES}) b ON a.cy = b.cy AND a.cx = b.cx AND a.k < b.k WHERE {HAVERSINE.format(a='a', b='b')} <= 0.15)"""


@query("cluster_within_radius", f"WITH RECURSIVE l AS {NEAR}, arc AS (SELECT a, b FROM l UNION SELECT b, a FROM l), reach AS (SELECT a, b FROM arc UNION SELECT r.a, arc.b FROM reach r JOIN arc ON r.b = arc.a) SELECT a AS record_key, least(a, min(b)) AS cluster_key FROM reach GROUP BY a")
def cluster_within_radius(spark, sf_dir):
    return linkage.components(cemetery_links(spark, sf_dir), "key_a", "key_b").select(F.col("id").alias("record_key"), F.col("component").alias("cluster_key"))


@query("spatial_dedup_confidence", f"SELECT key_a, key_b, round({LEV}, 6) AS sim, CASE WHEN ({LEV}) >= 0.8 THEN 'high' ELSE 'spatial_only' END AS confidence FROM (SELECT l.a AS key_a, l.b AS key_b, coalesce(x.name_normalized, '') AS na, coalesce(y.name_normalized, '') AS nb FROM {NEAR} l JOIN {CEMETERIES} x ON l.a = x.k JOIN {CEMETERIES} y ON l.b = y.k)")
def spatial_dedup_confidence(spark, sf_dir):
    n = sites(spark, sf_dir).where("vertical = 'deathcare'").select(record_key().alias("k"), "name_normalized")
    j = cemetery_links(spark, sf_dir).join(n.select(F.col("k").alias("key_a"), F.col("name_normalized").alias("na")), "key_a").join(n.select(F.col("k").alias("key_b"), F.col("name_normalized").alias("nb")), "key_b")
    sim = name_similarity(F.col("na"), F.col("nb"))
    return j.select("key_a", "key_b", F.round(sim, 6).alias("sim"), F.when(sim >= 0.8, "high").otherwise("spatial_only").alias("confidence"))


@query("ein_dedup_keep_first", f"SELECT source_id, natural_key, ein FROM {SITES} WHERE vertical = 'deathcare' AND NOT {present('ein')} UNION ALL SELECT source_id, natural_key, ein FROM {SITES} WHERE vertical = 'deathcare' AND {present('ein')} QUALIFY row_number() OVER (PARTITION BY ein ORDER BY source_id, natural_key) = 1")
def ein_dedup_keep_first(spark, sf_dir):
    d = sites(spark, sf_dir).where("vertical = 'deathcare'").select("source_id", "natural_key", "ein")
    bare = absent(F.col("ein"))
    first = d.where(~bare).groupBy("ein").agg(F.min(F.struct("source_id", "natural_key")).alias("k")).select("k.source_id", "k.natural_key", "ein")
    return d.where(bare).unionByName(first)


# --- keyed tables -----------------------------------------------------------------------------------------------------

@query("keep_last_dedup", "SELECT user_id, event_id, event_type, round(value, 6) AS value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def keep_last_dedup(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type", F.round("value", 6).alias("value")), F.struct("ts", "event_id")).alias("l")).select("user_id", "l.*")


@query("best_row_dedup", "SELECT natural_key, enrich_status, confidence, certificate_id FROM enrich_hoa_pdf_contact QUALIFY row_number() OVER (PARTITION BY natural_key ORDER BY CASE enrich_status WHEN 'ok' THEN 0 WHEN 'not_found' THEN 1 WHEN 'error' THEN 2 WHEN 'skipped' THEN 3 ELSE 4 END, coalesce(confidence, 0.0) DESC, enriched_at DESC) = 1")
def best_row_dedup(spark, sf_dir):
    t = table(spark, sf_dir, "enrich_hoa_pdf_contact")
    return keyed.keep_best(t, ["natural_key"], "enrich_status", {"ok": 0, "not_found": 1, "error": 2, "skipped": 3}, "confidence", "enriched_at").select("natural_key", "enrich_status", "confidence", "certificate_id")


OLD_SITES = "(SELECT * FROM staging_sites QUALIFY row_number() OVER (PARTITION BY source_id, natural_key ORDER BY loaded_at) = 1)"
CHANGES = ["name_raw", "address_line_1", "city", "phone_raw", "size_value", "loaded_at"]


@query("change_detecting_upsert", f"SELECT n.source_id, n.natural_key, n.name_raw FROM {SITES} n LEFT JOIN {OLD_SITES} o USING (source_id, natural_key) WHERE o.source_id IS NULL OR " + " OR ".join(f"n.{c} IS DISTINCT FROM o.{c}" for c in CHANGES))
def change_detecting_upsert(spark, sf_dir):
    t = table(spark, sf_dir, "staging_sites").where("source_id IS NOT NULL AND natural_key IS NOT NULL")
    old = t.groupBy("source_id", "natural_key").agg(F.min_by(F.struct(*CHANGES), "loaded_at").alias("o")).select("source_id", "natural_key", "o.*")
    return keyed.changed_rows(old, sites(spark, sf_dir), ["source_id", "natural_key"], CHANGES).select("source_id", "natural_key", "name_raw")


@query("geocode_overlay", f"SELECT n.source_id, n.natural_key, coalesce(CASE WHEN isnan(n.latitude) THEN NULL ELSE n.latitude END, o.latitude) AS latitude, CASE WHEN n.latitude IS NOT NULL AND NOT isnan(n.latitude) THEN 'source' WHEN o.latitude IS NOT NULL THEN 'geocode' END AS geometry_source FROM {SITES} n LEFT JOIN (SELECT source_id, natural_key, min(latitude) AS latitude FROM staging_sites WHERE latitude IS NOT NULL AND NOT isnan(latitude) GROUP BY 1, 2) o USING (source_id, natural_key)")
def geocode_overlay(spark, sf_dir):
    cache = table(spark, sf_dir, "staging_sites").where(~absent_number(F.col("latitude"))).groupBy("source_id", "natural_key").agg(F.min("latitude").alias("cached"))
    own = F.when(~absent_number(F.col("latitude")), F.col("latitude"))
    return sites(spark, sf_dir).join(cache, ["source_id", "natural_key"], "left").select("source_id", "natural_key", F.coalesce(own, "cached").alias("latitude"), F.when(own.isNotNull(), "source").when(F.col("cached").isNotNull(), "geocode").alias("geometry_source"))


@query("crosswalk_backfill", f"WITH x AS (SELECT zip5, min(upper(city)) AS town FROM {CMS} WHERE {present('zip5')} AND {present('city')} AND length(zip5) = 5 GROUP BY 1) SELECT s.source_id, s.natural_key, coalesce(CASE WHEN {present('s.city')} THEN s.city END, x.town) AS city, NOT {present('s.city')} AND x.town IS NOT NULL AS derived FROM {SITES} s LEFT JOIN x USING (zip5)")
def crosswalk_backfill(spark, sf_dir):
    x = facilities(spark, sf_dir).where(~absent(F.col("zip5")) & ~absent(F.col("city")) & (F.length("zip5") == 5)).groupBy("zip5").agg(F.min(F.upper("city")).alias("town"))
    own = F.when(~absent(F.col("city")), F.col("city"))
    return sites(spark, sf_dir).join(x, "zip5", "left").select("source_id", "natural_key", F.coalesce(own, "town").alias("city"), (own.isNull() & F.col("town").isNotNull()).alias("derived"))


@query("pdf_queue_order", "SELECT natural_key, certificate_id, row_number() OVER (ORDER BY CASE enrich_status WHEN 'error' THEN 1 WHEN 'not_found' THEN 2 ELSE 10 END, hoa_name NULLS LAST, natural_key) AS place FROM (SELECT * FROM enrich_hoa_pdf_contact QUALIFY row_number() OVER (PARTITION BY natural_key ORDER BY enriched_at DESC) = 1) ORDER BY place LIMIT 100")
def pdf_queue_order(spark, sf_dir):
    t = latest_rows(table(spark, sf_dir, "enrich_hoa_pdf_contact"), ["natural_key"], "enriched_at", columns=["certificate_id", "enrich_status", "hoa_name", "enriched_at"])
    rank = F.when(F.col("enrich_status") == "error", 1).when(F.col("enrich_status") == "not_found", 2).otherwise(10)
    top = t.orderBy(rank, F.asc_nulls_last("hoa_name"), "natural_key").limit(100)  # the first hundred of the queue: a top-k report
    listed = top.agg(F.array_sort(F.collect_list(F.struct(rank.alias("r"), F.col("hoa_name").isNull().alias("n"), "hoa_name", "natural_key", "certificate_id"))).alias("q"))
    return listed.select(F.posexplode("q").alias("i", "x")).select("x.natural_key", "x.certificate_id", (F.col("i") + 1).cast("long").alias("place"))


# --- served tables ----------------------------------------------------------------------------------------------------

def _diff_sql(t: str, key: str, hashed: list[str], guard: str = "TRUE") -> str:
    h = f"md5(concat_ws('|', {', '.join(hashed)}))"
    return f"""SELECT * FROM (SELECT coalesce(r.k, c.k) AS {key}, CASE WHEN c.k IS NULL THEN 'insert' WHEN r.k IS NULL THEN CASE WHEN c.may THEN 'tombstone' END WHEN r.h <> c.h THEN 'update' END AS action
      FROM (SELECT {key} AS k, {h} AS h FROM {SNAP.format(t=t, n=5, k=key)}) r FULL JOIN (SELECT {key} AS k, {h} AS h, {guard} AS may FROM {SNAP.format(t=t, n=4, k=key)}) c ON r.k = c.k) WHERE action IS NOT NULL"""


LOCATION_HASHED = ["location_name", "geocode_precision", "geometry_source", "acres_confidence", "site_type"]


@query("diff_actions_account", _diff_sql("resolved_account", "account_key", HASHED, "coalesce(status <> 'inactive', TRUE)"))
def diff_actions_account(spark, sf_dir):
    new, old = (snapshot(spark, sf_dir, "resolved_account", "account_key", n, HASHED) for n in (5, 4))
    return core.diff_actions(new, old, "account_key", HASHED, gone_filter=F.coalesce(F.col("status") != "inactive", F.lit(True)))


@query("diff_actions_location", _diff_sql("resolved_location", "location_key", LOCATION_HASHED))
def diff_actions_location(spark, sf_dir):
    new, old = (snapshot(spark, sf_dir, "resolved_location", "location_key", n, LOCATION_HASHED) for n in (5, 4))
    return core.diff_actions(new, old, "location_key", LOCATION_HASHED)


@query("diff_counts", f"SELECT 'account' AS kind, action, count(*) AS n FROM ({SQL['diff_actions_account']}) GROUP BY 1, 2 UNION ALL SELECT 'location', action, count(*) FROM ({SQL['diff_actions_location']}) GROUP BY 1, 2")
def diff_counts(spark, sf_dir):
    a = diff_actions_account(spark, sf_dir).groupBy("action").agg(F.count("*").alias("n")).select(F.lit("account").alias("kind"), "action", "n")
    return a.unionByName(diff_actions_location(spark, sf_dir).groupBy("action").agg(F.count("*").alias("n")).select(F.lit("location").alias("kind"), "action", "n"))


@query("applied_accounts", f"""WITH act AS ({SQL['diff_actions_account']}), r AS {SNAP.format(t='resolved_account', n=5, k='account_key')}, c AS {SNAP.format(t='resolved_account', n=4, k='account_key')}
  SELECT account_key, legal_name, status FROM c WHERE account_key NOT IN (SELECT account_key FROM act)
  UNION ALL SELECT account_key, legal_name, status FROM r WHERE account_key IN (SELECT account_key FROM act WHERE action <> 'tombstone')
  UNION ALL SELECT account_key, legal_name, 'merged' FROM c WHERE account_key IN (SELECT account_key FROM act WHERE action = 'tombstone')""")
def applied_accounts(spark, sf_dir):
    new, old = (snapshot(spark, sf_dir, "resolved_account", "account_key", n, HASHED) for n in (5, 4))
    return core.apply_diff(new, old, diff_actions_account(spark, sf_dir), "account_key", ["legal_name", "status"])


@query("tombstone_survivor", f"""WITH gone AS (SELECT c.account_key, c.name_normalized FROM {SNAP.format(t='resolved_account', n=4, k='account_key')} c WHERE c.account_key NOT IN (SELECT account_key FROM {SNAP.format(t='resolved_account', n=5, k='account_key')}))
  SELECT g.account_key, min(r.account_key) AS survivor_key FROM gone g LEFT JOIN {SNAP.format(t='resolved_account', n=5, k='account_key')} r ON r.name_normalized = g.name_normalized GROUP BY 1""")
def tombstone_survivor(spark, sf_dir):
    new, old = (snapshot(spark, sf_dir, "resolved_account", "account_key", n, ["name_normalized"]) for n in (5, 4))
    gone = old.join(new, "account_key", "left_anti").select("account_key", "name_normalized")
    heirs = new.groupBy("name_normalized").agg(F.min("account_key").alias("survivor_key"))
    return gone.join(heirs, "name_normalized", "left").select("account_key", "survivor_key")


@query("source_record_upsert", """WITH m AS (SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) AS middle FROM events WHERE props IS NOT NULL),
  e AS (SELECT CAST(user_id AS VARCHAR) AS natural_key, sha256(props) AS payload_sha, coalesce(CAST(ts AS TIMESTAMP) < middle, FALSE) AS early FROM events, m WHERE props IS NOT NULL)
  SELECT 'events' AS source_id, natural_key, payload_sha, CAST(CASE WHEN bool_or(early) THEN 1 ELSE 2 END AS BIGINT) AS first_run, CAST(CASE WHEN bool_or(NOT early) THEN 2 ELSE 1 END AS BIGINT) AS last_run FROM e GROUP BY 2, 3""")
def source_record_upsert(spark, sf_dir):
    # two deliveries that together hold every row: the events up to the middle stamp, and those from it on or without one
    e = table(spark, sf_dir, "events").where("props IS NOT NULL").select("ts", F.lit("events").alias("source_id"), F.col("user_id").cast("string").alias("natural_key"), F.col("props").alias("payload"))
    stamp = F.col("ts").cast("timestamp")
    middle = e.agg(F.timestamp_micros(F.floor((F.unix_micros(F.min(stamp)) + F.unix_micros(F.max(stamp))) / 2).cast("long")).alias("m")).first()["m"]
    first = F.coalesce(stamp < F.lit(middle), F.lit(False))
    empty = spark.createDataFrame([], "source_id string, natural_key string, payload_sha string, first_run long, last_run long")
    return core.upsert_provenance(core.upsert_provenance(empty, e.where(first), 1), e.where(~first), 2)


@query("pending_pairs_upsert", """WITH p AS (SELECT *, (source_id_a, natural_key_a) > (source_id_b, natural_key_b) AS flip FROM pending_pairs),
  q AS (SELECT CASE WHEN flip THEN source_id_b ELSE source_id_a END AS source_id_a, CASE WHEN flip THEN natural_key_b ELSE natural_key_a END AS natural_key_a, CASE WHEN flip THEN source_id_a ELSE source_id_b END AS source_id_b, CASE WHEN flip THEN natural_key_a ELSE natural_key_b END AS natural_key_b, merge_strategy, score, status, created_at, pending_pair_id FROM p),
  o AS (SELECT source_id_a, natural_key_a, source_id_b, natural_key_b, merge_strategy, arg_max(score, (created_at, pending_pair_id)) AS s, arg_max(status, (created_at, pending_pair_id)) AS st FROM q GROUP BY 1, 2, 3, 4, 5),
  n AS (SELECT source_id_a, natural_key_a, source_id_b, natural_key_b, 'rescore' AS merge_strategy, arg_min(score, (created_at, pending_pair_id)) AS ns FROM q GROUP BY 1, 2, 3, 4)
  SELECT source_id_a, natural_key_a, source_id_b, natural_key_b, merge_strategy, round(s, 6) AS score, st AS status FROM o UNION ALL SELECT source_id_a, natural_key_a, source_id_b, natural_key_b, merge_strategy, round(ns, 6), 'pending' FROM n""")
def pending_pairs_upsert(spark, sf_dir):
    p = table(spark, sf_dir, "pending_pairs").withColumn("ord", F.struct("created_at", "pending_pair_id"))
    out = core.upsert_review_pairs(p, p.withColumn("merge_strategy", F.lit("rescore")))
    return out.withColumn("score", F.round("score", 6))


# --- parks and regions --------------------------------------------------------------------------------------------------

PARKS = CUR.format(t="park_attrs")
PARK_COLUMNS = ["cluster_id", "name_normalized", "state", "latitude", "longitude", "manager_normalized", "acres_published", "acres_computed", "maintained_acres", "loaded_at"]
NUM = "CASE WHEN {c} > -1e300 AND NOT isnan({c}) THEN {c} END"


def parks(spark, sf_dir):
    return latest_rows(table(spark, sf_dir, "park_attrs"), ["source_id", "natural_key"], columns=PARK_COLUMNS)


def _num(c):
    return F.when(~absent_number(F.col(c)), F.col(c))


RECONCILED = f"(SELECT source_id, natural_key, cluster_id, state, coalesce(c, p) AS acres, CASE WHEN c IS NOT NULL THEN 'measured' WHEN p IS NOT NULL THEN 'estimated' ELSE 'banded' END AS acres_confidence, CASE WHEN c IS NOT NULL AND p > 0 THEN abs(c - p) / p END AS variance FROM (SELECT *, {NUM.format(c='acres_computed')} AS c, {NUM.format(c='acres_published')} AS p FROM {PARKS}))"


def reconciled(spark, sf_dir):
    c, p = _num("acres_computed"), _num("acres_published")
    return parks(spark, sf_dir).select("source_id", "natural_key", "cluster_id", "state", F.coalesce(c, p).alias("acres"), F.when(c.isNotNull(), "measured").when(p.isNotNull(), "estimated").otherwise("banded").alias("acres_confidence"), F.when(c.isNotNull() & (p > 0), F.abs(c - p) / p).alias("variance"))


@query("acreage_reconcile", f"SELECT source_id, natural_key, round(acres, 6) AS acres, acres_confidence, round(variance, 6) AS variance, coalesce(variance > 0.1, FALSE) AS disagrees FROM {RECONCILED}")
def acreage_reconcile(spark, sf_dir):
    return reconciled(spark, sf_dir).select("source_id", "natural_key", F.round("acres", 6).alias("acres"), "acres_confidence", F.round("variance", 6).alias("variance"), F.coalesce(F.col("variance") > 0.1, F.lit(False)).alias("disagrees"))


@query("acreage_variance_stats", f"SELECT source_id, count(*) AS n, count(variance) AS both, count(*) FILTER (WHERE variance > 0.1) AS off, round(median(variance), 4) AS typical FROM {RECONCILED} GROUP BY 1")
def acreage_variance_stats(spark, sf_dir):
    return reconciled(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("n"), F.count("variance").alias("both"), F.count_if(F.col("variance") > 0.1).alias("off"), F.round(F.percentile("variance", F.lit(0.5)), 4).alias("typical"))


@query("account_rollup", f"SELECT cluster_id, round(coalesce(sum(acres), 0.0), 4) AS acres, count(acres) AS parks FROM {RECONCILED} WHERE cluster_id IS NOT NULL GROUP BY 1")
def account_rollup(spark, sf_dir):
    return reconciled(spark, sf_dir).where("cluster_id IS NOT NULL").groupBy("cluster_id").agg(F.round(F.coalesce(F.sum("acres"), F.lit(0.0)), 4).alias("acres"), F.count("acres").alias("parks"))


@query("top5_accounts", f"SELECT cluster_id, round(coalesce(sum(acres), 0.0), 4) AS acres FROM {RECONCILED} WHERE cluster_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def top5_accounts(spark, sf_dir):
    return account_rollup(spark, sf_dir).select("cluster_id", "acres").orderBy(F.desc("acres"), "cluster_id").limit(5)


def governments(spark, sf_dir):
    bare = F.trim(F.regexp_replace(F.upper("name_raw"), r"^(CITY OF|TOWN OF|VILLAGE OF|BOROUGH OF|TOWNSHIP OF|COUNTY OF) | (COUNTY|TOWNSHIP|CITY|TOWN|VILLAGE|BOROUGH)$", ""))
    units = table(spark, sf_dir, "gov_unit_boundary").where("name_raw IS NOT NULL").select(F.col("source_id").alias("gov_source_id"), F.col("natural_key").alias("gov_natural_key"), "state", bare.alias("name_normalized"))
    # the towns that facilities name are places as well
    town = X.normalize_name(F.col("city"))
    towns = facilities(spark, sf_dir).where(~absent(F.col("city"))).select(F.lit("tiger_places").alias("gov_source_id"), F.concat_ws(":", F.lit("town"), "state", town).alias("gov_natural_key"), "state", town.alias("name_normalized")).distinct()
    return units.unionByName(towns)


def manager_names(spark, sf_dir):
    # abbreviations of county and township stand in the names as delivered
    m = F.regexp_replace(F.regexp_replace("manager_normalized", r"\bCNTY\b", "COUNTY"), r"\bTWP\b", "TOWNSHIP")
    return parks(spark, sf_dir).select("source_id", "natural_key", "state", m.alias("manager"))


@query("manager_parse_resolve")
def manager_parse_resolve(spark, sf_dir):
    return managers.resolve_managers(manager_names(spark, sf_dir), governments(spark, sf_dir)).withColumn("score", F.round("score", 6))


def assignments(spark, sf_dir):
    p = parks(spark, sf_dir).select(record_key().alias("key"), "source_id", "state", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    units = table(spark, sf_dir, "gov_unit_boundary").select(F.col("natural_key").alias("region"), F.col("boundary_geojson").alias("geojson"), "source_id")
    inside = materialize(spatial.containing_regions(p, units.where("source_id = 'tiger_places'")).groupBy("key").agg(F.min("region").alias("gov")), "inside")
    county = materialize(spatial.containing_regions(p, units.where("source_id = 'tiger_counties'")).groupBy("key").agg(F.min("region").alias("gov")), "county")
    best = manager_parse_resolve(spark, sf_dir)
    named = manager_names(spark, sf_dir).join(best, ["state", "manager"]).select(record_key().alias("key"), F.col("gov_natural_key").alias("gov"), "score")
    declared = p.where(F.col("source_id").endswith("state_parks")).select("key", F.concat(F.lit("state:"), F.col("state")).alias("gov"))
    return managers.combine_assignments(p, declared, inside, named, county)


@query("combine_assignments")
def combine_assignments(spark, sf_dir):
    return assignments(spark, sf_dir)


@query("review_candidates")
def review_candidates(spark, sf_dir):
    return assignments(spark, sf_dir).where((F.col("method") == "name") & (F.col("score") >= 0.75) & (F.col("score") < 0.92))


BOX = """(SELECT natural_key, min(p[1]) AS xmin, min(p[2]) AS ymin, max(p[1]) AS xmax, max(p[2]) AS ymax FROM (
  SELECT natural_key, unnest(flatten(flatten(CASE WHEN json_extract_string(boundary_geojson, '$.type') = 'Polygon' THEN [CAST(json_extract(boundary_geojson, '$.coordinates') AS DOUBLE[][][])] ELSE CAST(json_extract(boundary_geojson, '$.coordinates') AS DOUBLE[][][][]) END))) AS p
  FROM gov_unit_boundary WHERE boundary_geojson IS NOT NULL) GROUP BY 1)"""


@query("bbox_centroid", f"SELECT natural_key, (xmin + xmax) / 2 AS lon, (ymin + ymax) / 2 AS lat FROM {BOX}")
def bbox_centroid(spark, sf_dir):
    g = table(spark, sf_dir, "gov_unit_boundary").select("natural_key", polygons.box(F.col("boundary_geojson")).alias("b")).where("b.xmin IS NOT NULL")
    return g.select("natural_key", polygons.box_center(F.col("b")).alias("c")).select("natural_key", F.col("c.lon").alias("lon"), F.col("c.lat").alias("lat"))


@query("ring_area", """SELECT natural_key, round(sum(CASE WHEN i = 1 THEN a ELSE -a END), 6) AS area FROM (
  SELECT natural_key, part, i, abs(list_sum(list_transform(range(1, len(r)), lambda k: r[k][1] * r[k + 1][2] - r[k + 1][1] * r[k][2]))) / 2 AS a FROM (
    SELECT natural_key, part, unnest(rings) AS r, generate_subscripts(rings, 1) AS i FROM (
      SELECT natural_key, unnest(polys) AS rings, generate_subscripts(polys, 1) AS part FROM (
        SELECT natural_key, CASE WHEN json_extract_string(boundary_geojson, '$.type') = 'Polygon' THEN [CAST(json_extract(boundary_geojson, '$.coordinates') AS DOUBLE[][][])] ELSE CAST(json_extract(boundary_geojson, '$.coordinates') AS DOUBLE[][][][]) END AS polys FROM gov_unit_boundary WHERE boundary_geojson IS NOT NULL)))) GROUP BY 1""")
def ring_area(spark, sf_dir):
    return table(spark, sf_dir, "gov_unit_boundary").where("boundary_geojson IS NOT NULL").select("natural_key", F.round(polygons.planar_area(F.col("boundary_geojson")), 6).alias("area"))


RECT = "(SELECT p_partkey AS k, ((p_partkey - p_partkey % 3) * 37 % 4001) / 8.0 + (p_partkey % 3) / 16.0 AS x0, ((p_partkey - p_partkey % 3) * 53 % 3989) / 8.0 AS y0, 0.5 + p_size / 50.0 AS w, 0.5 + (p_partkey % 7) / 7.0 AS h FROM part)"


def rectangles(spark, sf_dir):
    third = F.pmod(F.col("p_partkey"), F.lit(3))
    base = F.col("p_partkey") - third
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size")).select(F.col("p_partkey").alias("key"), (F.pmod(base * 37, F.lit(4001)) / 8.0 + third / 16.0).alias("x0"), (F.pmod(base * 53, F.lit(3989)) / 8.0).alias("y0"), (0.5 + F.col("p_size") / 50.0).alias("w"), (0.5 + F.pmod(F.col("p_partkey"), F.lit(7)) / 7.0).alias("h"))
    x1, y1 = F.col("x0") + F.col("w"), F.col("y0") + F.col("h")
    at = lambda x, y: F.concat(F.lit("["), x.cast("string"), F.lit(","), y.cast("string"), F.lit("]"))
    ring = F.concat_ws(",", at(F.col("x0"), F.col("y0")), at(x1, F.col("y0")), at(x1, y1), at(F.col("x0"), y1), at(F.col("x0"), F.col("y0")))
    return p.select("key", F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}")).alias("geojson"))


@query("iou_pairs_rect", f"SELECT a, b, round(common / (wa + wb - common), 5) AS iou FROM (SELECT a.k AS a, b.k AS b, (least(a.x0 + a.w, b.x0 + b.w) - greatest(a.x0, b.x0)) * (least(a.y0 + a.h, b.y0 + b.h) - greatest(a.y0, b.y0)) AS common, a.w * a.h AS wa, b.w * b.h AS wb FROM {RECT} a JOIN {RECT} b ON a.k < b.k AND a.x0 < b.x0 + b.w AND b.x0 < a.x0 + a.w AND a.y0 < b.y0 + b.h AND b.y0 < a.y0 + a.h) WHERE common / (wa + wb - common) > 0.6 + 1e-9")
def iou_pairs_rect(spark, sf_dir):
    r = rectangles(spark, sf_dir)
    return polygons.overlap_pairs(r, r, same=True, over=0.6 + 1e-9).select("a", "b", F.round("iou", 5).alias("iou"))


@query("max_overlap_units")
def max_overlap_units(spark, sf_dir):
    g = table(spark, sf_dir, "gov_unit_boundary").where("boundary_geojson IS NOT NULL").select("source_id", F.col("natural_key").alias("key"), F.col("boundary_geojson").alias("geojson"))
    pairs_ = polygons.overlap_pairs(g.where("source_id <> 'tiger_counties'"), g.where("source_id = 'tiger_counties'"))
    return pairs_.groupBy(F.col("a").alias("natural_key")).agg(F.min_by(F.struct("b", "common"), F.struct(-F.col("common"), F.col("b"))).alias("m")).select("natural_key", F.col("m.b").alias("county_key"), F.round("m.common", 6).alias("common"))


# --- quality ------------------------------------------------------------------------------------------------------------

RATED = ["name_raw", "city", "zip5", "phone_normalized", "ein", "latitude"]


@query("fill_rates", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {present(c) if c != 'latitude' else '(latitude IS NOT NULL AND NOT isnan(latitude))'}) AS filled, count(*) AS total, round(count(*) FILTER (WHERE {present(c) if c != 'latitude' else '(latitude IS NOT NULL AND NOT isnan(latitude))'}) / CAST(count(*) AS DOUBLE), 6) AS fill_rate FROM staging_sites" for c in RATED))
def fill_rates(spark, sf_dir):
    return quality.fill_rates(table(spark, sf_dir, "staging_sites"), RATED).withColumn("fill_rate", F.round("fill_rate", 6))


@query("value_counts_topn", "SELECT city AS value, count(*) AS n FROM staging_sites GROUP BY 1 ORDER BY n DESC, value NULLS LAST LIMIT 20")
def value_counts_topn(spark, sf_dir):
    return quality.value_counts(table(spark, sf_dir, "staging_sites"), "city", 20)


@query("empty_key_fraction", f"SELECT source_id, count(*) AS n, round(avg(CASE WHEN {present('ein')} THEN 0.0 ELSE 1.0 END), 6) AS blank_fraction, count(DISTINCT natural_key) AS keys FROM staging_sites GROUP BY 1")
def empty_key_fraction(spark, sf_dir):
    return table(spark, sf_dir, "staging_sites").groupBy("source_id").agg(F.count("*").alias("n"), F.round(F.avg(F.when(absent(F.col("ein")), 1.0).otherwise(0.0)), 6).alias("blank_fraction"), F.countDistinct("natural_key").alias("keys"))


# --- collapse and sequence ------------------------------------------------------------------------------------------------

@query("lodging_funnel_collapse", "SELECT l_orderkey, max(l_quantity) AS units, count(*) AS unit_rows, CAST(date_diff('day', DATE '1970-01-01', CAST(arg_min(l_shipdate, (l_linenumber, l_shipdate)) AS DATE)) AS BIGINT) AS first_ship FROM lineitem WHERE l_linestatus = 'F' AND l_quantity >= 20 GROUP BY 1")
def lodging_funnel_collapse(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F' AND l_quantity >= 20")
    return l.groupBy("l_orderkey").agg(F.max("l_quantity").alias("units"), F.count("*").alias("unit_rows"), F.datediff(F.to_date(F.min_by("l_shipdate", F.struct("l_linenumber", "l_shipdate"))), F.lit("1970-01-01").cast("date")).cast("long").alias("first_ship"))


@query("funnel_counts", "SELECT count(*) AS all_rows, count(*) FILTER (WHERE l_linestatus = 'F') AS open_rows, count(*) FILTER (WHERE l_linestatus = 'F' AND l_quantity >= 20) AS sized_rows, count(DISTINCT CASE WHEN l_linestatus = 'F' AND l_quantity >= 20 THEN l_orderkey END) AS licenses FROM lineitem")
def funnel_counts(spark, sf_dir):
    ok = F.col("l_linestatus") == "F"
    big = ok & (F.col("l_quantity") >= 20)
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("all_rows"), F.count_if(ok).alias("open_rows"), F.count_if(big).alias("sized_rows"), F.countDistinct(F.when(big, F.col("l_orderkey"))).alias("licenses"))


@query("facility_org_filter_join_seq", "SELECT c_custkey, o_orderkey, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS location_seq, CAST(c_custkey AS VARCHAR) || '|' || CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS VARCHAR) AS natural_key FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def facility_org_filter_join_seq(spark, sf_dir):
    from pyspark.sql import Window

    c = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")
    j = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(c, "c_custkey")
    seq = F.row_number().over(Window.partitionBy("c_custkey").orderBy("o_orderkey")).cast("long")
    return j.select("c_custkey", "o_orderkey", seq.alias("location_seq")).withColumn("natural_key", F.concat_ws("|", F.col("c_custkey").cast("string"), F.col("location_seq").cast("string")))


@query("resolve_segment_leads", f"SELECT source_id, natural_key, CASE WHEN {present('segment')} THEN segment WHEN {present('ein')} THEN 'religious' ELSE 'municipal' END AS segment, coalesce(CASE WHEN {present('segment')} THEN segment WHEN {present('ein')} THEN 'religious' ELSE 'municipal' END NOT IN ('municipal', 'federal') AND {present('name_normalized')}, FALSE) AS is_lead FROM {SITES} WHERE vertical = 'deathcare'")
def resolve_segment_leads(spark, sf_dir):
    seg = F.when(~absent(F.col("segment")), F.col("segment")).when(~absent(F.col("ein")), "religious").otherwise("municipal")
    return sites(spark, sf_dir).where("vertical = 'deathcare'").select("source_id", "natural_key", seg.alias("segment"), (~seg.isin("municipal", "federal") & ~absent(F.col("name_normalized"))).alias("is_lead"))


# --- enrichment -----------------------------------------------------------------------------------------------------------

@query("certificate_fields")
def certificate_fields(spark, sf_dir):
    """Every document and the certificate fields it carries; enrich_status not_found without any."""
    return table(spark, sf_dir, "documents").select("doc_id", parse_fields(F.col("text")).alias("f")).select("doc_id", "f.*")


ASSESSOR = f"""WITH l AS (SELECT natural_key AS key, state AS county, {name('address_line_1')} AS addr FROM {CMS} WHERE {present('address_line_1')}),
  p AS (SELECT natural_key AS parcel, state AS county, {name('address_line_1')} AS p_addr, size_value AS acres FROM {SITES} WHERE source_id = 'nppes_practice_locations' AND {present('address_line_1')} AND {name('address_line_1')} <> ''),
  near AS (SELECT key, parcel, acres, addr AS na, p_addr AS nb FROM l JOIN p ON l.county = p.county AND left(addr, 5) = left(p_addr, 5)),
  alone AS (SELECT key, parcel, acres, addr AS na, p_addr AS nb FROM l JOIN p ON l.county = p.county WHERE key NOT IN (SELECT key FROM near)),
  best AS (SELECT key, parcel, score FROM (SELECT key, parcel, {LEV} AS score FROM (SELECT * FROM near UNION ALL SELECT * FROM alone)) QUALIFY row_number() OVER (PARTITION BY key ORDER BY score DESC, parcel) = 1)
  SELECT l.key, CASE WHEN score >= 0.7 THEN parcel END AS parcel, round(CASE WHEN score >= 0.7 THEN score END, 6) AS score, CASE WHEN NOT EXISTS (SELECT 1 FROM p WHERE p.county = l.county) THEN 'bad_county' WHEN coalesce(score, 0) < 0.7 THEN 'no_match' ELSE 'found' END AS status FROM l LEFT JOIN best USING (key)"""


@query("assessor_best_match", ASSESSOR)
def assessor_best_match(spark, sf_dir):
    l = facilities(spark, sf_dir).where(~absent(F.col("address_line_1"))).select(F.col("natural_key").alias("key"), F.col("state").alias("county"), F.col("address_line_1").alias("address"))
    p = sites(spark, sf_dir).where((F.col("source_id") == "nppes_practice_locations") & ~absent(F.col("address_line_1"))).select(F.col("natural_key").alias("parcel"), F.col("state").alias("county"), F.col("address_line_1").alias("address"), F.col("size_value").alias("acres"))
    out = enrichment.best_address(materialize(l, "locations"), materialize(p, "parcels"))
    return out.select("key", "parcel", F.round("score", 6).alias("score"), F.when(F.col("status").isin("ok", "no_acreage"), "found").otherwise(F.col("status")).alias("status"))


@query("layer_routing_status", "SELECT natural_key AS key, CASE WHEN state = 'FL' THEN 'statewide' WHEN state = 'TX' AND county_fips < '48200' THEN 'county' END AS layer, CASE WHEN state NOT IN ('FL', 'TX') THEN 'state_not_supported' WHEN state = 'TX' AND NOT coalesce(county_fips < '48200', FALSE) THEN 'county_not_configured' ELSE 'ok' END AS status FROM gov_unit_boundary WHERE state IS NOT NULL")
def layer_routing_status(spark, sf_dir):
    g = table(spark, sf_dir, "gov_unit_boundary").where("state IS NOT NULL").select(F.col("natural_key").alias("key"), "state", F.col("county_fips").alias("fips"))
    local = g.where("state = 'TX' AND fips < '48200'").select("state", "fips", F.lit("county").alias("layer")).distinct()
    wide = spark.createDataFrame([("FL", None, "statewide"), ("TX", "none", "county")], "state string, fips string, layer string")
    return enrichment.route_layers(g, wide.unionByName(local)).select("key", "layer", "status")


@query("geocode_answers", f"SELECT natural_key AS id, latitude, longitude, CASE WHEN latitude IS NULL THEN NULL WHEN length(natural_key) % 2 = 0 THEN 'rooftop' ELSE 'street' END AS precision, CASE WHEN latitude IS NULL THEN 'no_match' ELSE 'ok' END AS status FROM (SELECT natural_key, CASE WHEN isnan(latitude) OR isnan(longitude) OR longitude IS NULL THEN NULL ELSE latitude END AS latitude, CASE WHEN isnan(longitude) OR isnan(latitude) OR latitude IS NULL THEN NULL ELSE longitude END AS longitude FROM {CMS})")
def geocode_answers(spark, sf_dir):
    ok = ~absent_number(F.col("latitude")) & ~absent_number(F.col("longitude"))
    at = F.concat(F.lit('"'), F.col("longitude").cast("string"), F.lit(","), F.col("latitude").cast("string"), F.lit('"'))
    line = F.concat_ws(",", "natural_key", F.lit('"1 A St, Town"'), F.when(ok, "Match").otherwise("No_Match"), F.when(ok, F.when(F.length("natural_key") % 2 == 0, "Exact").otherwise("Non_Exact")).otherwise(""), F.lit('"1 A ST, TOWN"'), F.when(ok, at).otherwise(""))
    return enrichment.geocoder_answers(facilities(spark, sf_dir).select(line.alias("value")))


@query("best_place_match", f"""WITH c AS (SELECT a.natural_key AS key, b.natural_key AS place, CASE WHEN len(list_intersect(list_filter(string_split(upper(a.name_raw), ' '), lambda w: length(w) > 3), string_split(upper(b.name_raw), ' '))) > 0 THEN 4 ELSE 0 END
    + CASE WHEN a.city <> '' AND contains(upper(b.address_line_1 || ', ' || b.city || ' ' || b.state), upper(a.city)) THEN 3 ELSE 0 END + CASE WHEN a.state <> '' AND contains(upper(b.address_line_1 || ', ' || b.city || ' ' || b.state), upper(a.state)) THEN 2 ELSE 0 END AS score
    FROM {CMS} a JOIN {SITES} b ON a.zip5 = b.zip5 AND b.source_id = 'nppes_practice_locations' WHERE b.address_line_1 IS NOT NULL AND b.city IS NOT NULL AND b.state IS NOT NULL AND length(a.zip5) = 5)
  SELECT key, place, score FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY score DESC, place) = 1""")
def best_place_match(spark, sf_dir):
    a = facilities(spark, sf_dir).where(F.length("zip5") == 5).select(F.col("natural_key").alias("key"), "zip5", F.col("name_raw").alias("n"), F.col("city").alias("c"), F.col("state").alias("s"))
    b = sites(spark, sf_dir).where("source_id = 'nppes_practice_locations' AND address_line_1 IS NOT NULL AND city IS NOT NULL AND state IS NOT NULL").select(F.col("natural_key").alias("place"), "zip5", F.col("name_raw").alias("d"), F.concat(F.col("address_line_1"), F.lit(", "), F.col("city"), F.lit(" "), F.col("state")).alias("at"))
    scored = a.join(b, "zip5").select("key", "place", X.place_score(F.col("n"), F.coalesce("c", F.lit("")), F.coalesce("s", F.lit("")), F.lit(""), F.col("d"), F.col("at")).alias("score"))
    return enrichment.best_place(scored)


@query("contact_survivorship", f"""WITH s AS (SELECT sha256(source_id || natural_key) AS account_key, * FROM {SITES} WHERE vertical = 'deathcare'), e AS (SELECT account_key, 'primary_phone' AS role, 'enriched' AS full_name, phone_raw AS phone FROM s WHERE {present('ein')} AND {present('phone_raw')})
  SELECT account_key, role, full_name, phone FROM (SELECT account_key, 'primary_phone' AS role, name_raw AS full_name, phone_normalized AS phone FROM s UNION ALL SELECT account_key, 'owner', name_raw, NULL FROM s) b WHERE role <> 'primary_phone' OR account_key NOT IN (SELECT account_key FROM e) UNION ALL SELECT * FROM e""")
def contact_survivorship(spark, sf_dir):
    s = sites(spark, sf_dir).where("vertical = 'deathcare'").withColumn("account_key", F.sha2(F.concat("source_id", "natural_key"), 256))
    contact = lambda df, role, who, phone: df.select("account_key", F.lit(role).alias("role"), who.alias("full_name"), phone.alias("phone"))
    base = contact(s, "primary_phone", F.col("name_raw"), F.col("phone_normalized")).unionByName(contact(s, "owner", F.col("name_raw"), F.lit(None).cast("string")))
    enriched = contact(s.where(~absent(F.col("ein")) & ~absent(F.col("phone_raw"))), "primary_phone", F.lit("enriched"), F.col("phone_raw"))
    return enrichment.merged_contacts(base, enriched)


@query("parcel_totals", "SELECT CAST(l_orderkey AS VARCHAR) AS key, round(sum(CASE WHEN l_quantity > 0 THEN l_quantity END), 4) AS acres, CASE WHEN count(*) > 1 THEN 'ok_multi_parcel' ELSE 'ok' END AS status FROM lineitem GROUP BY 1")
def parcel_totals(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("key"), F.col("l_partkey").cast("string").alias("parcel"), F.col("l_quantity").alias("acres"), F.col("l_suppkey").cast("string").alias("owner"))
    return enrichment.parcel_totals(l).select("key", "acres", "status")


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
