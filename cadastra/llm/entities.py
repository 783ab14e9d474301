"""Matching entities across sources without keys.

BM25 over an inverted index of all attributes, with exact pruning: a query reads the postings of its rarest tokens only,
as many as are needed that the others together can't lift a record to the floor; partial scores that can't reach it
are dropped before any attribute is fetched. The best candidate of a query stands if it is also near the best of its
record, with a confidence from score gap and attribute agreement by a logistic regression trained on the pairs themselves.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.addresses import _near, signatures
from cadastra.runtime import absent, materialize

K1, B = 1.2, 0.3
#: Records taken for a query, the best by score.
TOP = 1000
#: Share of a query's own score below which a record is none of them; 0 takes the best whatever their score.
FLOOR = 0.4
#: Records of a token that one task reads.
POSTINGS = 5_000
#: Share of its record's best score that a query's pair must have: another query that fits far better has the record's place.
MUTUAL = 0.3
#: Share of records above which a name word is too usual to be worth a token together with the town.
USUAL_SHARE = 0.01
#: Rows that the calibration is fitted on at most; they are taken by hash.
TRAINING_ROWS = 50_000
# Words of facility names and their abbreviations.
NAME_WORDS = {
    "HLTH": "HEALTH", "CTR": "CENTER", "CNTR": "CENTER", "CENTRE": "CENTER", "CTRE": "CENTER", "HOSP": "HOSPITAL", "HSP": "HOSPITAL", "HSPTL": "HOSPITAL", "REHAB": "REHABILITATION",
    "NSG": "NURSING", "NURS": "NURSING", "SURG": "SURGERY", "SURGICAL": "SURGERY", "DIAL": "DIALYSIS", "MED": "MEDICAL", "FAM": "FAMILY", "CMNTY": "COMMUNITY", "COMM": "COMMUNITY",
    "BEHAV": "BEHAVIORAL", "BEHAVIOURAL": "BEHAVIORAL", "SVCS": "SERVICES", "SVC": "SERVICES", "SERV": "SERVICES", "MEM": "MEMORIAL", "MEML": "MEMORIAL", "REG": "REGIONAL", "REGL": "REGIONAL", "RGNL": "REGIONAL",
    "VLY": "VALLEY", "ST": "SAINT", "MT": "MOUNT", "FT": "FORT", "LK": "LAKE", "N": "NORTH", "CHILDRENS": "CHILDREN", "CHLDRN": "CHILDREN", "KIDS": "CHILDREN", "CLN": "CLINIC", "CLIN": "CLINIC", "SR": "SENIOR", "LVG": "LIVING", "SPGS": "SPRINGS",
}
EMPTY_WORDS = ["THE", "AND", "OF", "AT", "A", "S", "L", "C", "P", "INC", "LLC", "LP", "LTD", "CORP", "CO", "DBA", "PC", "PA", "PLLC", "ASSOC", "ASSOCS", "ASSOCIATES", "ASSN"]


def name_words(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in NAME_WORDS.items() for x in kv])
    words = F.split(F.trim(F.regexp_replace(F.regexp_replace(F.upper(c), "['’]S\\b", ""), "[^A-Z0-9]+", " ")), " ")
    short = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.array_distinct(F.filter(short, lambda w: ~w.isin("", *EMPTY_WORDS)))


def _cell(lat: Column, lon: Column, dy: int = 0, dx: int = 0) -> Column:
    return F.concat(F.lit("g:"), (F.floor(lat / 0.004) + dy).cast("string"), F.lit(","), (F.floor(lon / 0.005) + dx).cast("string"))


def attributes(records: DataFrame) -> DataFrame:
    """(key, name, digits, dir, type, words, town, zip, phone, lat, lon, ein) in one spelling each."""
    signed = signatures(records.select("key", "address", "city", "state", "zip5"))
    town = F.when(~absent(F.col("city")), F.trim(F.regexp_replace(F.upper("city"), "[^A-Z]+", " ")))
    phone = F.coalesce(*[F.nullif(F.right(F.regexp_replace(c, "[^0-9]", ""), F.lit(10)), F.lit("")) for c in ("phone_normalized", "phone_raw")])
    lat, lon = F.col("latitude"), F.col("longitude")
    placed = lat.between(-90, 90) & lon.between(-180, 180) & ((lat != 0) | (lon != 0))
    ein = F.regexp_replace("ein", "[^0-9]", "")
    base = records.select(
        "key", name_words(F.coalesce(F.when(~absent(F.col("name_normalized")), F.col("name_normalized")), F.col("name_raw"))).alias("name"), town.alias("city"),
        F.nullif(F.regexp_extract(F.trim("zip5"), r"^(\d{5})", 1), F.lit("")).alias("zip"), F.when(F.length(phone) == 10, phone).alias("phone"),
        F.when(placed, lat).alias("lat"), F.when(placed, lon).alias("lon"), F.when(F.length(ein) == 9, ein).alias("ein"),
    )
    return base.join(signed, "key", "left").withColumn("town", F.coalesce("town", "city")).drop("city")


def _tokens(around: bool, usual: list[str]) -> Column:
    """All attributes as tokens; name words but the usual ones also together with the town, numbers also with a street word."""
    tag = lambda mark, c: F.when(c.isNotNull(), F.concat(F.lit(mark), c))
    own = F.when(F.col("lat").isNotNull() & F.col("lon").isNotNull(), F.array(*[_cell(F.col("lat"), F.col("lon"), y, x) for y in ((-1, 0, 1) if around else (0,)) for x in ((-1, 0, 1) if around else (0,))]))
    parts = F.concat(
        F.transform("name", lambda w: F.concat(F.lit("n:"), w)),
        F.coalesce(F.transform(F.filter("name", lambda w: ~w.isin(usual)), lambda w: F.concat(F.lit("x:"), w, F.lit("@"), F.col("town"))), F.array().cast("array<string>")),
        F.coalesce(F.transform("words", lambda w: F.concat(F.lit("a:"), F.col("digits"), F.lit(" "), w)), F.array().cast("array<string>")),
        F.array(tag("d:", F.concat_ws("@", "digits", "town")), tag("t:", F.col("town")), tag("z:", F.col("zip")), tag("p:", F.col("phone")), tag("e:", F.col("ein"))),
        F.coalesce(own, F.array().cast("array<string>")),
    )
    return F.array_distinct(F.filter(parts, lambda t: t.isNotNull()))


def candidates(records: DataFrame, queries: DataFrame, *, k: int = TOP, floor: float = FLOOR) -> DataFrame:
    """(query, record, score, own): the `k` records of highest BM25 score for every query, of those that reach `floor` of its own score.

    `records` and `queries` are attributes(). A query's tokens are read from the rarest on; reading stops when those left
    can't add up to the floor, so no record that reaches it is missed, and the longest postings are never read. The k-th
    best of the partial scores is then a bound: a record whose partial score with all that is left stays below it can't be
    among the k best, and goes before any attribute is fetched. `floor` 0 reads everything: the k best whatever their score.
    """
    # each of these words stands in over a hundredth of all names: a short list at any size
    everyone = records.count()
    counted = records.select(F.explode("name").alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    usual = [x.w for x in counted.where(F.col("n") > max(2.0, USUAL_SHARE * everyone)).collect()]
    docs = records.select(F.col("key").alias("record"), _tokens(False, usual).alias("tokens"))
    docs = materialize(docs.withColumn("len", F.size("tokens")), "docs")
    stats = docs.agg(F.count("*").alias("n"), F.coalesce(F.avg("len"), F.lit(1.0)).alias("avg")).first()
    n, avg = float(stats["n"]), float(stats["avg"])
    postings = docs.select("record", ((K1 + 1) / (1 + K1 * (1 - B + B * F.col("len") / avg))).alias("norm"), F.explode("tokens").alias("t"))
    idf = postings.groupBy("t").agg(F.count("*").alias("df"), F.max("norm").alias("top"))
    idf = idf.select("t", "df", F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("w"), "top", (F.floor(F.col("df") / POSTINGS) + 1).cast("int").alias("parts"))
    idf = materialize(idf, "idf")
    asked = queries.select(F.col("key").alias("query"), F.explode(_tokens(True, usual)).alias("t"))
    asked = asked.join(idf, "t")
    # what a record could score at most, and the query's own score: its tokens at the usual length, the nine cells as one
    cell = F.col("t").startswith("g:")
    per = Window.partitionBy("query")
    asked = asked.withColumn("own", F.sum(F.when(cell, F.lit(0.0)).otherwise(F.col("w"))).over(per) + F.coalesce(F.max(F.when(cell, F.col("w"))).over(per), F.lit(0.0)))
    asked = asked.withColumn("after", F.sum(F.col("w") * F.col("top")).over(per.orderBy(F.desc("df"), "t").rowsBetween(Window.unboundedPreceding, 0)))
    asked = asked.withColumn("read", F.col("after") >= floor * F.col("own"))
    asked = materialize(asked.withColumn("rest", F.coalesce(F.max(F.when(~F.col("read"), F.col("after"))).over(per), F.lit(0.0))), "asked")
    # a long posting list is spread over parts, so that the queries of a usual token meet it in several tasks
    spread = postings.join(idf.where("parts > 1").select("t", "parts"), "t", "left").withColumn("part_no", F.pmod(F.xxhash64("record"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    read = asked.where("read").withColumn("part_no", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    part = read.join(spread, ["t", "part_no"]).groupBy("query", "record").agg(F.sum(F.col("w") * F.col("norm")).alias("part"), F.max("own").alias("own"), F.max("rest").alias("rest"))
    part = materialize(part.where(F.col("part") + F.col("rest") >= floor * F.col("own")), "partial")
    best = Window.partitionBy("query").orderBy(F.desc("part"), "record")
    bound = part.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k).groupBy("query").agg(F.min("part").alias("bound"), F.count("*").alias("_k"))
    able = part.join(bound, "query").where((F.col("_k") < k) | (F.col("part") + F.col("rest") >= F.col("bound"))).select("query", "record", "own")
    able = materialize(able, "able")
    weights = asked.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("t", "w"))).alias("weights"))
    full = able.join(weights, "query").join(docs, "record")
    hit = F.filter("tokens", lambda t: F.map_contains_key("weights", t))
    score = F.aggregate(hit, F.lit(0.0), lambda s, t: s + F.try_element_at("weights", t)) * ((K1 + 1) / (1 + K1 * (1 - B + B * F.col("len") / avg)))
    scored = full.select("query", "record", score.alias("score"), "own").where(F.col("score") >= floor * F.col("own"))
    first = Window.partitionBy("query").orderBy(F.desc("score"), "record")
    return scored.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k).drop("_n")


def _alike(w: Column, v: Column) -> Column:
    return (w == v) | ((F.length(w) >= 4) & _near(w, v))


def _odd_word(a: Column, b: Column) -> Column:
    """Rarity of the rarest word of `a` that `b` lacks, 1 from a rarity of 8."""
    lone = F.filter(a, lambda w: ~F.exists(b, lambda v: _alike(w["word"], v["word"])))
    return F.least(F.lit(1.0), F.coalesce(F.array_max(F.transform(lone, lambda w: w["rarity"])), F.lit(0.0)) / 8)


def _weighed_share(a: Column, b: Column) -> Column:
    """The same by rarity; `a` and `b` are arrays of (word, rarity)."""
    hit = F.filter(a, lambda w: F.exists(b, lambda v: _alike(w["word"], v["word"])))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, w: s + w["rarity"])
    return total(hit) / F.greatest(total(a), F.lit(1e-9))


FEATURES = ["own_share", "gap", "mutual", "name", "odd_word", "street", "street_off", "place", "near", "phone", "phone_off", "ein", "ein_off", "alone"]


def pair_features(found: DataFrame, records: DataFrame, queries: DataFrame, rarity: DataFrame) -> DataFrame:
    """`found` with the attributes' agreement and the score gaps on both sides."""
    q = queries.select(F.col("key").alias("query"), *[F.col(c).alias("q_" + c) for c in queries.columns if c != "key"])
    r = records.select(F.col("key").alias("record"), *[F.col(c).alias("r_" + c) for c in records.columns if c != "key"])
    t = found.join(q, "query").join(r, "record").join(rarity.select(F.col("key").alias("query"), F.col("weighed").alias("q_weighed")), "query", "left").join(rarity.select(F.col("key").alias("record"), F.col("weighed").alias("r_weighed")), "record", "left")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    same = lambda c: F.col("q_" + c) == F.col("r_" + c)
    words = F.coalesce(F.greatest(F.size(F.filter("q_words", lambda w: F.exists("r_words", lambda v: _alike(w, v)))) / F.greatest(F.size("q_words"), F.lit(1)), F.when(_near(F.array_join("q_words", ""), F.array_join("r_words", "")), 1.0)), F.lit(0.0))
    street = same("digits") & ((words >= 0.5) | ((F.size("q_words") == 0) & (F.size("r_words") == 0))) & F.coalesce(same("town") | same("zip") | (F.levenshtein("q_town", "r_town") <= 2), F.lit(True))
    km = 111.19 * F.sqrt(F.pow(F.col("q_lat") - F.col("r_lat"), 2) + F.pow((F.col("q_lon") - F.col("r_lon")) * F.cos(F.radians("q_lat")), 2))
    t = t.select(
        "query", "record", "score", "own",
        (F.col("score") / F.col("own")).alias("own_share"),
        F.coalesce(F.least(_weighed_share(F.col("q_weighed"), F.col("r_weighed")), _weighed_share(F.col("r_weighed"), F.col("q_weighed"))), F.lit(0.0)).alias("name"),
        flag(street).alias("street"), flag(~street & F.col("q_digits").isNotNull() & F.col("r_digits").isNotNull()).alias("street_off"),
        flag(same("zip") | same("town") | (F.levenshtein("q_town", "r_town") <= 2)).alias("place"), F.coalesce(F.exp(-km / 0.3), F.lit(0.3)).alias("near"),
        flag(same("ein")).alias("ein"), flag(F.col("q_ein") != F.col("r_ein")).alias("ein_off"),
        flag(same("phone")).alias("phone"), flag(F.col("q_phone") != F.col("r_phone")).alias("phone_off"),
        (1 - F.coalesce(F.least(F.lit(1.0), F.array_max(F.transform("q_weighed", lambda w: w["rarity"])) / 8), F.lit(0.0))).alias("usual"),
        F.coalesce(F.greatest(_odd_word(F.col("q_weighed"), F.col("r_weighed")), _odd_word(F.col("r_weighed"), F.col("q_weighed"))), F.lit(1.0)).alias("odd_word"),
    )
    # a name of usual words, with nothing but the place beside it
    t = t.withColumn("alone", F.when((F.col("street") + F.col("phone") + F.col("ein") == 0) & (F.col("near") <= 0.6), F.col("usual")).otherwise(0.0)).drop("usual")
    by_q = Window.partitionBy("query").orderBy(F.desc("score"), "record")
    best_r = Window.partitionBy("record")
    t = t.withColumn("place_q", F.row_number().over(by_q)).withColumn("next", F.lead("score").over(by_q)).withColumn("first", F.first("score").over(by_q))
    other = F.when(F.col("place_q") == 1, F.coalesce("next", F.lit(0.0))).otherwise(F.col("first"))
    return t.withColumn("gap", (F.col("score") - other) / F.col("own")).withColumn("mutual", F.col("score") / F.max("score").over(best_r)).drop("next", "first")


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the first weight is the intercept."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + ridge * np.r_[0, w[1:]] / 10
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + np.eye(x.shape[1]) * ridge / 10
        w -= np.linalg.solve(h, g)
    return w


def matched_entities(records: DataFrame, queries: DataFrame, *, accept: float = 0.5, k: int = TOP, floor: float = FLOOR, mutual: float = MUTUAL, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """(query, record, confidence): for each query at most one record that is the same entity.

    Both tables are (key, name_raw, name_normalized, address, city, state, zip5, phone_raw, phone_normalized, latitude,
    longitude, ein), any but the key NULL; rows with a NULL key are dropped, and a key must stand once. Equal confidences go
    to the higher score, then the smaller record key. Several queries may have one record. Empty tables give an empty result.

    The calibration needs no labels: pairs whose names and places agree, and one of street, phone, employer number and
    position with them, are taken as the same; pairs whose names don't, whose place is another, or that share
    a name of usual words but neither street nor phone, as different. The
    logistic regression over score gaps and agreements decides the rest. It is fitted on at most `training_rows` pairs of
    each kind, taken by hash, so that a hot name can't crowd out the others.
    """
    r = materialize(attributes(records.where("key IS NOT NULL")), "records")
    q = materialize(attributes(queries.where("key IS NOT NULL")), "queries")
    found = candidates(r, q, k=k, floor=floor)
    everyone = r.select("key", "name", "town").unionByName(q.select("key", "name", "town"))
    total = float(max(1, everyone.count()))
    # a town's name in a facility's name tells towns apart, not facilities, so it has no weight of its own
    spread = everyone.select("key", F.explode(F.filter("name", lambda w: ~F.coalesce(F.exists(F.split("town", " "), lambda v: _alike(w, v)), F.lit(False)))).alias("word"))
    common = spread.groupBy("word").agg(F.log(1 + F.lit(total) / F.count("*")).alias("rarity"))
    rarity = spread.join(common, "word").groupBy("key").agg(F.collect_list(F.struct("word", "rarity")).alias("weighed"))
    pairs = materialize(pair_features(found, r, q, rarity), "pairs")
    support = F.col("street") + F.col("phone") + F.col("ein") + (F.col("near") > 0.6).cast("int")
    label = F.when((F.col("name") >= 0.9) & (F.col("odd_word") < 0.3) & (F.col("place") == 1) & (support >= 1), 1.0).when((F.col("name") < 0.6) | ((F.col("place") == 0) & (support == 0)) | ((F.col("alone") > 0.4) & (F.col("street_off") == 1)), 0.0)
    told = pairs.select(*FEATURES, label.alias("y"), F.xxhash64("query", "record").alias("h"))
    sample = told.where("y = 1").orderBy("h").limit(training_rows).unionByName(told.where("y = 0").orderBy("h").limit(training_rows)).toPandas()
    if 0 < sample["y"].sum() < len(sample):
        w = _fit(sample[FEATURES].to_numpy(dtype=float), sample["y"].to_numpy(dtype=float))
    else:  # nothing to learn from: agreement of name, and of street or phone, decides
        w = np.array([-6.0] + [{"name": 5.0, "street": 3.0, "phone": 3.0}.get(f, 0.0) for f in FEATURES])
    z: Column = F.lit(float(w[0]))
    for name, weight in zip(FEATURES, w[1:]):
        z = z + F.col(name) * float(weight)
    scored = pairs.withColumn("confidence", 1 / (1 + F.exp(-z)))
    best = scored.groupBy("query").agg(F.max_by(F.struct("record", "confidence", "mutual"), F.struct("confidence", "score", -F.col("place_q"))).alias("b"))
    # nearest to one another: the record is the query's best, and the query near the best of the record, which may have several
    return best.select("query", "b.*").where((F.col("confidence") >= accept) & (F.col("mutual") >= mutual)).drop("mutual")
