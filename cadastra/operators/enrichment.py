"""Enrichment joins: parcels, assessor rolls, geocoder answers, layer routing, contact survivorship."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.similarity import name_similarity
from cadastra.functions.text import normalize_name
from cadastra.runtime import broadcast_if_small


def positive_acres(c: Column) -> Column:
    """A text of acres with thousands' commas as a positive number, else NULL."""
    v = F.regexp_replace(c, ",", "").try_cast("double")
    return F.when((v > 0) & ~F.isnan(v), v)


def best_address(locations: DataFrame, parcels: DataFrame, *, threshold: float = 0.7) -> DataFrame:
    """(key, parcel, acres, score, status) for each of `locations` (key, county, address), from `parcels` (parcel, county, address, acres).

    Addresses are compared within a county whose first five letters agree; a location without such a neighbour is
    compared with all parcels of its county. The highest similarity wins, then the smaller parcel id. status is bad_county,
    no_match (below `threshold`), no_acreage or ok.
    """
    p = parcels.select("parcel", F.col("county").alias("p_county"), normalize_name(F.col("address")).alias("p_addr"), positive_acres(F.col("acres").cast("string")).alias("acres")).where("p_addr <> ''")
    l = locations.select("key", "county", normalize_name(F.col("address")).alias("addr"))
    prefix = F.left("p_addr", F.lit(5)).alias("prefix")
    near = l.withColumn("prefix", F.left("addr", F.lit(5))).join(p.withColumn("prefix", prefix), ["prefix"]).where("county = p_county")
    alone = l.join(near.select("key").distinct(), "key", "left_anti").join(p, F.col("county") == F.col("p_county"))
    cols = ["key", "parcel", "acres", name_similarity(F.col("addr"), F.col("p_addr")).alias("score")]
    scored = near.select(*cols).unionByName(alone.select(*cols))
    best = scored.groupBy("key").agg(F.min_by(F.struct("parcel", "acres", "score"), F.struct(-F.col("score"), F.col("parcel"))).alias("b"))
    known = p.select(F.col("p_county").alias("county")).distinct().withColumn("known", F.lit(True))
    j = l.join(broadcast_if_small(known), "county", "left").join(best, "key", "left")
    hit = F.col("b.score") >= threshold
    status = F.when(F.col("known").isNull(), "bad_county").when(~F.coalesce(hit, F.lit(False)), "no_match").when(F.col("b.acres").isNull(), "no_acreage").otherwise("ok")
    take = lambda c: F.when(hit & F.col("known"), F.col(f"b.{c}")).alias(c)
    return j.select("key", take("parcel"), take("acres"), take("score"), status.alias("status"))


def route_layers(rows: DataFrame, layers: DataFrame) -> DataFrame:
    """`rows` (key, state, fips) with the layer of their state, else of their county, from `layers` (state, fips, layer); a statewide layer has a NULL fips."""
    wide = layers.where("fips IS NULL").groupBy("state").agg(F.min("layer").alias("wide"))
    local = layers.where("fips IS NOT NULL").groupBy("fips").agg(F.min("layer").alias("local"))
    states = layers.select("state").distinct().withColumn("any", F.lit(True))
    j = rows.join(broadcast_if_small(wide), "state", "left").join(broadcast_if_small(local), "fips", "left").join(broadcast_if_small(states), "state", "left")
    layer = F.coalesce("wide", "local")
    return j.select("key", "state", "fips", layer.alias("layer"), F.when(F.col("any").isNull(), "state_not_supported").when(layer.isNull(), "county_not_configured").otherwise("ok").alias("status"))


def parcel_totals(hits: DataFrame) -> DataFrame:
    """(key, acres, parcels, owners, status) of (key, parcel, acres, owner) hits: acres above zero summed, ids and owners in order, each owner once."""
    a = hits.groupBy("key").agg(
        F.sum(F.when(F.col("acres") > 0, F.col("acres"))).alias("acres"), F.count("parcel").alias("n"),
        F.array_join(F.array_sort(F.collect_set("parcel")), "; ").alias("parcels"), F.array_join(F.array_sort(F.collect_set(F.nullif(F.trim("owner"), F.lit("")))), "; ").alias("owners"),
    )
    status = F.when(F.col("n") == 0, "not_found").when(F.col("acres").isNull(), "no_area_field").when(F.col("n") > 1, "ok_multi_parcel").otherwise("ok")
    return a.select("key", F.round("acres", 4).alias("acres"), "parcels", "owners", status.alias("status"))


GEOCODER_SCHEMA = "id string, input string, match string, kind string, matched string, lonlat string, tiger string, side string"


def geocoder_answers(lines: DataFrame, column: str = "value") -> DataFrame:
    """(id, latitude, longitude, precision, status) of a batch geocoder's CSV lines: Exact matches are rooftop, others street, no match NULL."""
    t = lines.select(F.from_csv(F.col(column), GEOCODER_SCHEMA).alias("r")).select("r.*").where("id IS NOT NULL")
    hit = F.lower(F.trim("match")) == "match"
    part = lambda i: F.when(hit, F.get(F.split("lonlat", ","), F.lit(i)).try_cast("double"))
    found = part(0).isNotNull() & part(1).isNotNull()
    return t.select("id", F.when(found, part(1)).alias("latitude"), F.when(found, part(0)).alias("longitude"), F.when(found, F.when(F.lower(F.trim("kind")) == "exact", "rooftop").otherwise("street")).alias("precision"), F.when(found, "ok").otherwise("no_match").alias("status"))


def merged_contacts(base: DataFrame, enriched: DataFrame, role: str = "primary_phone") -> DataFrame:
    """Contacts (account_key, role, full_name, phone) of `base`, those of `role` dropped where `enriched` has the account, and `enriched` added."""
    covered = enriched.select("account_key").distinct().withColumn("_c", F.lit(True))
    kept = base.join(covered, "account_key", "left").where(F.col("_c").isNull() | (F.col("role") != role)).drop("_c")
    return kept.unionByName(enriched)


def best_place(rows: DataFrame, key: str = "key", score: str = "score", order: str = "place") -> DataFrame:
    """The highest-scored candidate of each key, the first of equals."""
    w = Window.partitionBy(key).orderBy(F.desc(score), order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
