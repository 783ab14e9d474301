"""Manager names to government units: parse, block, score, pick; then one assignment per park from several sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.similarity import compound_name_similarity

# Entity words before and after a government's name, with the class they claim.
ENTITY_PREFIXES = {"CITY OF": "place", "TOWN OF": "place", "VILLAGE OF": "place", "BOROUGH OF": "place", "MUNICIPALITY OF": "place", "TOWNSHIP OF": "cousub", "COUNTY OF": "county"}
ENTITY_SUFFIXES = {"COUNTY": "county", "PARISH": "county", "TOWNSHIP": "cousub", "TWP": "cousub", "CITY": "place", "TOWN": "place", "VILLAGE": "place", "BOROUGH": "place"}
# Departmental words that may trail a government's name.
ROLE_WORDS = [
    "PARKS", "PARK", "RECREATION", "REC", "RECREATIONAL", "DEPARTMENT", "DEPT", "DIVISION", "DIV", "BUREAU", "OFFICE", "PUBLIC", "WORKS", "CULTURAL", "RESOURCES", "RESOURCE",
    "BOARD", "COMMISSION", "COMMISSIONERS", "AUTHORITY", "DISTRICT", "MUNICIPAL", "MUNICIPALITY", "GOVERNMENT", "GOVT", "OPEN", "SPACE", "SPACES", "CONSERVATION", "CONSERVANCY",
    "LANDS", "TRUST", "SERVICES", "SERVICE", "FACILITIES", "COMMUNITY", "LEISURE", "GREENWAY", "GREENWAYS", "TRAILS", "AND", "OF", "THE", "PRECINCT", "PCT", "WARD", "SECTOR", "ZONE",
    "REGION", "UNIT", "NO", "NUM", "PROGRAM", "PROGRAMS", "SYSTEM", "MAINTENANCE", "GROUNDS", "ADMINISTRATION", "MANAGEMENT", "MGMT",
]
# Layers a class may match, preferred first.
CLASS_LAYERS = {"place": ["tiger_places", "tiger_cousub"], "cousub": ["tiger_cousub", "tiger_places"], "county": ["tiger_counties"], "any": ["tiger_places", "tiger_cousub", "tiger_counties"]}
AUTO, QUEUE = 0.92, 0.75


def parse_manager(c: Column) -> Column:
    """struct(variants, entity_class): candidate names of the government, shortest trim of trailing role words first.

    All in built-in functions: the tail of role words and bare numbers is found as the last word that is neither.
    """
    text = F.trim(F.regexp_replace(F.upper(c), r"\s+", " "))
    prefix = F.regexp_extract(text, "^(" + "|".join(sorted(ENTITY_PREFIXES, key=len, reverse=True)) + ") ", 1)
    rest = F.when(prefix != "", F.substring(text, F.length(prefix) + 2, F.length(text))).otherwise(text)
    words = F.filter(F.split(F.trim(rest), " "), lambda w: w != "")
    role = lambda w: w.isin(ROLE_WORDS) | w.rlike("^[0-9]+$")
    n = F.size(words)
    # words kept when the whole tail of role words goes, one at least
    kept = F.greatest(F.least(F.lit(1), n), F.coalesce(F.array_max(F.filter(F.transform(words, lambda w, i: F.when(~role(w), i + 1)), lambda i: i.isNotNull())), F.lit(1)))
    last = F.get(words, kept - 1)
    ends = (kept > 1) & last.isin(*ENTITY_SUFFIXES)
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    cls = F.coalesce(F.try_element_at(table(ENTITY_PREFIXES), prefix), F.when(ends, F.try_element_at(table(ENTITY_SUFFIXES), last)))
    ladder = F.transform(F.sequence(kept, F.greatest(n, kept)), lambda i: F.array_join(F.slice(words, F.lit(1), i), " "))
    bare = F.when(ends, F.array(F.array_join(F.slice(words, F.lit(1), kept - 1), " "))).otherwise(F.array().cast("array<string>"))
    variants = F.when(n > 0, F.array_distinct(F.filter(F.concat(bare, ladder), lambda v: v != ""))).otherwise(F.array().cast("array<string>"))
    return F.struct(variants.alias("variants"), cls.alias("entity_class"))


def resolve_managers(managers: DataFrame, governments: DataFrame, *, queue: float = QUEUE) -> DataFrame:
    """(state, manager, gov_source_id, gov_natural_key, score): the best government of each distinct manager name.

    `managers` is (state, manager), `governments` (gov_source_id, gov_natural_key, state, name_normalized). Names are
    compared within a state that share their first four letters, in the layers that the entity class permits. Higher scores win,
    then the longer variant, then the preferred layer, then the smaller key. Work is per distinct name, not per park.
    """
    parsed = managers.where(F.trim("manager") != "").select("state", "manager").distinct().withColumn("p", parse_manager(F.col("manager")))
    v = parsed.select("state", "manager", F.coalesce("p.entity_class", F.lit("any")).alias("cls"), F.explode("p.variants").alias("variant")).withColumn("block", F.left("variant", F.lit(4)))
    layers = F.create_map(*[x for c, ls in CLASS_LAYERS.items() for x in (F.lit(c), F.array(*map(F.lit, ls)))])
    g = governments.select("gov_source_id", "gov_natural_key", "state", F.col("name_normalized").alias("gov_name"), F.left("name_normalized", F.lit(4)).alias("block"))
    pairs = v.join(g, ["state", "block"]).withColumn("rank", F.array_position(F.try_element_at(layers, F.col("cls")), F.col("gov_source_id"))).where("rank > 0")
    scored = pairs.withColumn("score", F.when(F.col("variant") == F.col("gov_name"), 1.0).otherwise(compound_name_similarity(F.col("variant"), F.col("gov_name"))))
    w = Window.partitionBy("state", "manager").orderBy(F.desc("score"), F.desc(F.length("variant")), "rank", "gov_source_id", "gov_natural_key")
    best = scored.withColumn("n", F.row_number().over(w)).where("n = 1").where(F.col("score") >= queue)
    return best.select("state", "manager", "gov_source_id", "gov_natural_key", "score")


def combine_assignments(parks: DataFrame, declared: DataFrame, spatial: DataFrame, named: DataFrame, county: DataFrame) -> DataFrame:
    """(key, gov, method, score): declared agency, else spatial (with or without the name agreeing), else name, else county.

    Each source is (key, gov[, score]) with one row per key.
    """
    j = parks.select("key")
    for name, df in (("d", declared), ("s", spatial), ("n", named), ("c", county)):
        cols = [F.col("gov").alias(name)] + ([F.col("score").alias("n_score")] if name == "n" else [])
        j = j.join(df.select("key", *cols), "key", "left")
    by_name = F.col("n").isNotNull() & (F.col("n_score") >= QUEUE)
    method = (
        F.when(F.col("d").isNotNull(), "declared_agency").when(F.col("s").isNotNull() & by_name & (F.col("s") == F.col("n")), "spatial+name")
        .when(F.col("s").isNotNull(), "spatial").when(by_name, "name").when(F.col("c").isNotNull(), "county_fallback")
    )
    gov = F.coalesce("d", "s", F.when(by_name, F.col("n")), "c")
    return j.select("key", gov.alias("gov"), method.alias("method"), F.when(method.isin("name", "spatial+name"), F.col("n_score")).alias("score"))
