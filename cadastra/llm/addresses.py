"""Same postal address written differently, numbers first.

Addresses are brought to one spelling in SQL, blocked on their sorted digit tokens plus one rare word, and compared by
the rarity of the words they share, with levenshtein on the words they don't. Directions and street types must agree
where both state them; suites, floors and buildings are left out.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.runtime import absent, evenly, materialize

# The short spelling of every word that postal addresses abbreviate.
SHORT_WORDS = {
    "STREET": "ST", "STR": "ST", "SAINT": "ST", "ROAD": "RD", "WAY": "WY", "LOOP": "LP", "PLACE": "PL", "LANE": "LN", "BOULEVARD": "BLVD", "BOUL": "BLVD",
    "COURT": "CT", "CRT": "CT", "DRIVE": "DR", "DRV": "DR", "CIRCLE": "CIR", "CIRC": "CIR", "TRAIL": "TRL", "TR": "TRL", "TERRACE": "TER", "TERR": "TER",
    "PARKWAY": "PKWY", "PKY": "PKWY", "AVENUE": "AVE", "AV": "AVE", "AVEN": "AVE", "HIGHWAY": "HWY", "SQUARE": "SQ", "PLAZA": "PLZ",
    "NORTH": "N", "NO": "N", "SOUTH": "S", "SO": "S", "EAST": "E", "WEST": "W", "NORTHEAST": "NE", "NORTHWEST": "NW", "SOUTHEAST": "SE", "SOUTHWEST": "SW",
    "LAKE": "LK", "FORT": "FT", "MOUNT": "MT", "SPRINGS": "SPGS", "MOUNTAIN": "MTN", "HEIGHTS": "HTS", "JUNCTION": "JCT",
    "FIRST": "1ST", "SECOND": "2ND", "THIRD": "3RD", "FOURTH": "4TH", "FIFTH": "5TH", "SIXTH": "6TH", "SEVENTH": "7TH", "EIGHTH": "8TH", "NINTH": "9TH", "TENTH": "10TH",
    "ELEVENTH": "11TH", "TWELFTH": "12TH", "THIRTEENTH": "13TH", "FOURTEENTH": "14TH", "FIFTEENTH": "15TH", "SIXTEENTH": "16TH",
}
STREET_TYPES = ["ST", "RD", "WY", "LP", "PL", "LN", "BLVD", "CT", "DR", "CIR", "TRL", "TER", "PKWY", "AVE", "HWY", "SQ", "PLZ"]
DIRECTIONS = ["N", "S", "E", "W", "NE", "NW", "SE", "SW"]
HOUSE_WORDS = ["ONE", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "NINE", "TEN", "ELEVEN", "TWELVE"]
STATES = {"TEXAS": "TX", "FLORIDA": "FL", "NORTH CAROLINA": "NC", "N CAROLINA": "NC", "SOUTH CAROLINA": "SC", "S CAROLINA": "SC", "PENNSYLVANIA": "PA"}
STATE_CODES = "TX|FL|NC|SC|PA"
# Roads known by a number, each with the name it takes here.
NUMBERED_ROADS = [
    (r"\b(FARM[ -]TO[ -]MARKET|F M|FM)( ROAD| RD)? ?-? ?(?=\d)", "FM "),
    (r"\b(COUNTY|CNTY|CO) (ROAD|RD) ?-? ?(?=\d)|\b(C R|CR) ?-? ?(?=\d)", "CR "),
    (r"\b(STATE|ST) (ROAD|RD|ROUTE|RTE|HIGHWAY|HWY) ?-? ?(?=\d)|\b(S R|SR|S H|SH) ?-? ?(?=\d)", "SR "),
    (r"\b(UNITED STATES|U S|US) ?(HIGHWAY|HWY|ROUTE|RTE)? ?-? ?(?=\d)", "HWY "),
    (r"\b(HIGHWAY|HWY) ?-? ?(?=\d)", "HWY "),
]
UNIT = r"(?:\b(?:SUITE|STE|UNIT|APARTMENT|APT|BUILDING|BLDG|ROOM|RM|FLOOR|FLR)\b ?#? ?[A-Z0-9]+(?: ?- ?[A-Z0-9]+)?\b|\bFL ?(?:\d{1,2}(?:ST|ND|RD|TH)|\d{1,2})\b(?!-)|\b\d{1,2}(?:ST|ND|RD|TH) (?:FLOOR|FLR)\b|# ?[A-Z0-9]+(?: ?- ?[A-Z0-9]+)?\b)"


def _each(c: Column, steps: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, s: F.regexp_replace(t, s[0], s[1]), steps, c)


def _shorten(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in SHORT_WORDS.items() for x in kv])
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")


def town_text(c: Column) -> Column:
    """A town's name with its common first and last words written out."""
    return _written_out(F.trim(_shorten(F.trim(F.regexp_replace(F.regexp_replace(F.upper(c), r"[.']", ""), r"[^A-Z]+", " ")))))


def _written_out(c: Column) -> Column:
    """Short words of town names in full, so that a slip within one is an edit apart."""
    return _each(c, [(r"^N (?=[A-Z])", "NORTH "), (r"^S (?=[A-Z])", "SOUTH "), (r"^LK ", "LAKE "), (r"^FT ", "FORT "), (r"^MT ", "MOUNT "), (r"^ST ", "SAINT "), (r" SPGS$", " SPRINGS"), (r" HTS$", " HEIGHTS")])


def _deletes(c: Column) -> Column:
    """The text and all texts with one letter left out: two texts an edit or a swap apart share one."""
    return F.array_distinct(F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))))


def state_code(c: Column) -> Column:
    """A state's two letters from its letters or name; other text in capitals."""
    t = F.upper(F.trim(F.regexp_replace(c, "[^A-Za-z]+", " ")))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in STATES.items() for x in kv]), t), t)


def parsed_lines(addresses: DataFrame) -> DataFrame:
    """(key, line, state, zip, box, city) of (key, address, city, state, zip5): the address in short words without unit, state, zip and care-of.

    Commas in `line` part what was on different lines or behind separators.
    """
    text = F.when(~absent(F.col("address")), F.upper("address"))
    text = _each(text, [
        (r"[\r\n;|]+", " , "), (r"\s+[-–—]+\s+", " , "), (r",", " , "), (r"[.'’\"]", ""), (r"[^A-Z0-9,#/& -]", " "), (r"\s+", " "),
        (r"(?:MAILING ADDRESS|MAIL TO|ADDRESS) ?:? ", ""),
        (r"(?:\bC/O\b|\bATTN\b|\bATTENTION\b|\b(?:IN )?CARE OF\b)", " , "),
        (r"\b(?:U S A|USA)\b|\bUNITED STATES\b(?= ?(?:,|$))", " "), (r"\s+", " "), (r"^[ ,]+", ""), (r"(^|, )(\d+) , (?=[A-Z0-9])", "$1$2 "),
    ])
    text = _each(text, NUMBERED_ROADS)
    text = F.regexp_replace(text, r"\b(?:P ?O ?B(?:OX)?|POST OFFICE BOX|POST OFFICE|BOX)(?: BOX)? ?#? ?(?:NO )?(?=\d)", "POBOX ")
    for name, code in STATES.items():
        text = F.regexp_replace(text, rf"\b{name}\b", code)
    df = addresses.select("key", "city", "state", "zip5", text.alias("t"))
    df = df.withColumn("t", _each(F.col("t"), [(UNIT, " , "), (r"[&/#]", " "), (r"\s+", " "), (r"(?: ?,)+", " ,"), (r"^[ ,]+|[ ,]+$", ""), (r"(?<!FM|CR|SR|HWY|POBOX) (\d{1,4}) , (?=[A-Z0-9])", " , $1 ")]))
    # a zip follows a state, or has four more digits, or ends a line, or comes after the house number
    t = F.col("t")
    by_state = F.regexp_extract(t, rf"\b(?:{STATE_CODES}) ?,? ?(\d{{5}})(?:-?\d{{4}})?(?= ?,|$| \d)", 1)
    plus_four = F.regexp_extract(t, r"\b(\d{5})-\d{4}\b", 1)
    at_end = F.regexp_extract(t, r"\b(\d{5})(?= ,|$)", 1)
    later = F.regexp_extract(t, r"\d[^,]*.*?[ ,](\d{5})\b(?=[ ,]|$)", 1)
    found = F.coalesce(*[F.when(x != "", x) for x in (by_state, plus_four, at_end, later)])
    given = F.regexp_extract(F.trim("zip5"), r"^(\d{5})(?:\.0|-?\d{4})?$", 1)
    df = df.withColumn("found_zip", found)
    rest = F.array_join(F.transform(F.split(t, " "), lambda w: F.when((w == F.col("found_zip")) | (w.rlike(r"^\d{5}-\d{4}$") & (F.left(w, F.lit(5)) == F.col("found_zip"))), ",").otherwise(w)), " ")
    state = F.regexp_extract(t, rf"\b({STATE_CODES})\b(?!.*\b(?:{STATE_CODES})\b)", 1)
    df = df.select(
        "key", F.when(~absent(F.col("city")), town_text(F.col("city"))).alias("city"),
        F.coalesce(F.when(~absent(F.col("state")), state_code(F.col("state"))), F.when(state != "", state)).alias("state"),
        F.coalesce(F.when(given != "", given), "found_zip").alias("zip"),
        F.nullif(F.regexp_extract(t, r"\bPOBOX (\d+)", 1), F.lit("")).alias("box"),
        F.trim(_each(rest, [(rf"\b(?:{STATE_CODES})\b(?= ?(?:,|$))|(?<=, )(?:{STATE_CODES})\b", ","), (r"POBOX \d+", ","), (r"\s+", " "), (r"(?: ?,)+", " ,"), (r"^[ ,]+|[ ,]+$", "")])).alias("t"),
    )
    numbers = F.create_map(*[F.lit(x) for i, w in enumerate(HOUSE_WORDS) for x in (w, str(i + 1))])
    word = F.regexp_extract(F.col("t"), rf"(?:^|, )({'|'.join(HOUSE_WORDS)}) [A-Z0-9]", 1)
    spelled = F.regexp_replace(F.col("t"), F.concat(F.lit(r"(^|, )"), word, F.lit(r" (?=[A-Z0-9])")), F.concat(F.lit("$1"), F.try_element_at(numbers, word), F.lit(" ")))
    line = F.when((word != "") & ~F.col("t").rlike(r"(^|, )\d+ [A-Z0-9]"), spelled).otherwise(F.col("t"))
    return df.select("key", "city", "state", "zip", "box", _shorten(F.regexp_replace(line, r"(^|, )(\d+) , ", "$1$2 ")).alias("line"))


def towns(lines: DataFrame) -> DataFrame:
    """(name, town): every spelling of a city column, with the far more frequent one that it's a slip of, else itself."""
    names = materialize(lines.where(F.col("city") != "").groupBy(F.col("city").alias("name")).agg(F.count("*").alias("n")), "towns")
    long = names.where(F.length("name") >= 6)
    a = long.select("name", "n", F.explode(_deletes(F.col("name"))).alias("d"))
    b = long.select(F.col("name").alias("other"), F.col("n").alias("m"), F.explode(_deletes(F.col("name"))).alias("d"))
    slips = a.join(b, "d").where((F.col("m") >= 4 * F.col("n")) & (F.levenshtein("name", "other") <= 2))
    meant = slips.groupBy("name").agg(F.max_by("other", F.struct("m", "other")).alias("town"))
    return names.join(meant, "name", "left").select("name", F.coalesce("town", "name").alias("town"))


def _with_towns(lines: DataFrame) -> DataFrame:
    """Adds town and named (the words that gave it): the city column, or the longest known name in the line, slips allowed; else by the zip."""
    known = materialize(towns(lines), "town")
    words = F.filter(F.split("line", " "), lambda w: w != "")
    grams = F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0))), lambda i: F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: F.struct(F.array_join(F.slice(words, i + 1, n), " ").alias("name"), i.alias("at"), n.alias("n")))))
    grams = F.filter(grams, lambda g: (g["at"] + g["n"] <= F.size(words)) & g["name"].rlike("^[A-Z][A-Z ]+$"))
    grams = F.transform(grams, lambda g: F.struct(_written_out(g["name"]).alias("name"), g["name"].alias("raw"), g["at"].alias("at"), g["n"].alias("n")))
    told = F.when(F.col("city").isNotNull(), F.array(F.struct(F.col("city").alias("name"), F.col("city").alias("raw"), F.lit(0).alias("at"), F.lit(9).alias("n")))).otherwise(grams)
    cand = lines.select("key", F.inline(told))
    exact = cand.join(known, "name").groupBy("key").agg(F.max_by(F.struct("raw", "town"), F.struct("n", "at")).alias("e"))
    seen = materialize(lines.join(exact, "key", "left"), "lines")
    vague = seen.where("e IS NULL").select("key", F.inline(told)).where(F.length("name") >= 6).select("key", "name", "raw", "at", "n", F.explode(_deletes(F.col("name"))).alias("d"))
    slips = known.where("name = town").where(F.length("town") >= 6).select("town", F.explode(_deletes(F.col("town"))).alias("d"))
    near = vague.join(slips, "d").withColumn("far", F.levenshtein("name", "town")).where("far <= 2")
    near = near.groupBy("key").agg(F.min_by(F.struct("raw", "town"), F.struct("far", -F.col("n"), -F.col("at"))).alias("v"))
    full = seen.join(near, "key", "left").withColumn("f", F.coalesce("e", "v"))
    zips = full.where("zip IS NOT NULL AND f IS NOT NULL").groupBy("zip", F.col("f.town").alias("t")).count()
    zips = zips.groupBy("zip").agg(F.max_by("t", F.struct("count", "t")).alias("zip_town"), (F.max("count") / F.sum("count")).alias("sure")).where("sure >= 0.6")
    full = full.join(zips.select("zip", "zip_town"), "zip", "left")
    full = full.select("key", "line", "state", "zip", "box", F.coalesce("f.town", F.when(F.col("city").isNull(), F.col("zip_town")), "city").alias("town"), F.when(F.col("city").isNull(), F.col("f.raw")).alias("named"))
    # a state that isn't stated is the only one that others state with the zip, or with the town
    full = materialize(full, "placed")
    for by in ("zip", "town"):
        one = full.where(F.col(by).isNotNull() & F.col("state").isNotNull()).groupBy(by).agg(F.min("state").alias(f"{by}_state"), F.max("state").alias("_m")).where(F.col(f"{by}_state") == F.col("_m")).drop("_m")
        full = full.join(one, by, "left")
    return full.withColumn("state", F.coalesce("state", "zip_state", "town_state")).drop("zip_state", "town_state")


#: What a place is told by; NULL state, direction and type agree with any.
SIGNATURE = ["digits", "town", "state", "dir", "type", "words"]


def signatures(addresses: DataFrame) -> DataFrame:
    """(key, digits, town, state, dir, type, words): what decides whether two addresses denote the same place."""
    rows = _with_towns(materialize(parsed_lines(evenly(addresses)), "parsed"))
    # the words that gave the town are cut out where they stand last
    line, name = F.concat(F.lit(" "), "line", F.lit(" ")), F.concat(F.lit(" "), "named", F.lit(" "))
    tail = F.call_function("substring_index", line, name, F.lit(-1))
    head = F.left(line, F.length(line) - F.length(tail) - F.length(name))
    cut = F.when(F.col("named").isNotNull() & F.contains(line, name), F.concat(head, F.lit(" , "), tail)).otherwise(F.col("line"))
    rows = rows.select("key", "town", "state", "box", F.trim(F.regexp_replace(cut, r"\s+", " ")).alias("line"))
    told = evenly(rows).mapInArrow(_told, "key string, digits string, town string, state string, dir string, type string, words array<string>")
    return told.where("digits IS NOT NULL AND town IS NOT NULL")


START = re.compile(r"(?:^|[ ,])([0-9]+)(?:-?[A-Z])? ((?:[0-9]+(?:ST|ND|RD|TH)|[A-Z])[^,]*)")


def _street(line: str | None) -> tuple:
    """(digits, dir, type, words) of an address line: its house number and the numbers in the street's name, then the rest of the name."""
    m = START.search(line or "")
    if not m:
        return None, None, None, []
    codes = STATE_CODES.split("|")
    name = [w for w in m.group(2).split(" ") if w not in ("", "-") and w not in codes]
    side = kind = None
    if len(name) > 1 and name[-1] in DIRECTIONS:
        side = name.pop()
    elif len(name) > 1 and name[0] in DIRECTIONS:
        side = name.pop(0)
    if len(name) > 1 and name[-1] in STREET_TYPES:
        kind = name.pop()
    numbers = [w for w in name if w[0] in "0123456789"]
    words = [w for w in name if w[0] not in "0123456789"]
    if not (words or numbers or kind):
        return None, None, None, []
    return " ".join(sorted([m.group(1).lstrip("0") or "0", *numbers])), side, kind, words


def _told(batches):
    import pyarrow as pa

    for b in batches:
        key, town, state, box, line = (b.column(i).to_pylist() for i in range(5))
        found = [(f"B{x}", None, None, []) if x is not None else _street(t) for x, t in zip(box, line)]
        digits, side, kind, words = (list(c) for c in zip(*found)) if found else ([], [], [], [])
        columns = [pa.array(c, pa.string()) for c in (key, digits, town, state, side, kind)] + [pa.array(words, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["key", *SIGNATURE])


def _near(a: Column, b: Column) -> Column:
    """One edit or swap apart; two edits for long words."""
    swapped = (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    far = F.levenshtein(a, b)
    return (far <= 1) | ((far <= 2) & (swapped | (F.least(F.length(a), F.length(b)) >= 7)))


def _variants(w: Column) -> Column:
    """The word and all that is left of it without one or two letters: two words at most two edits apart share one."""
    return F.array_distinct(F.concat(_deletes(w), F.flatten(F.transform(_deletes(w), _deletes))))


#: Distinct spellings of a number and town that are compared with one another; larger blocks are split by rare words.
BLOCK = 200
#: Records of a place that are paired in one task.
MEMBERS = 1000


def _aliases(places: DataFrame) -> DataFrame:
    """(town, alias): every town with itself and with those of one edit's difference, six letters at least."""
    names = materialize(places.select("town").distinct(), "towns")
    keyed = names.where(F.length("town") >= 6).select("town", F.explode(_deletes(F.col("town"))).alias("d"))
    near = keyed.join(keyed.select(F.col("town").alias("alias"), "d"), "d").where((F.col("town") < F.col("alias")) & (F.levenshtein("town", "alias") <= 1))
    return names.select("town", F.col("town").alias("alias")).unionByName(near.select("town", "alias").distinct())


def _blocks(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of the comparison, each with its `block`.

    A block is a number with a town. Where BLOCK spellings or more share one, it takes a word besides: one side asks by
    its rarest words, as many as outweigh the share that may differ, the other answers by all, each word in all
    spellings that slips can give it; so no accepted pair is missed, and the streets of a city don't all meet.
    """
    spread = places.join(_aliases(places), "town").withColumn("spot", F.concat_ws("|", "digits", "alias"))
    many = spread.groupBy("spot").count().where(F.col("count") >= BLOCK).select("spot", F.lit(True).alias("many"))
    spread = materialize(spread.join(many, "spot", "left"), "spots")
    small = spread.where("many IS NULL").withColumn("block", F.col("spot"))
    large = spread.where("many")
    # from the rarest word on, until the others weigh less than what must be shared
    by_weight = F.reverse(F.array_sort(F.transform("words", lambda w: F.struct(F.coalesce(F.try_element_at("rarity", w), F.lit(1.0)).alias("r"), w.alias("w")))))
    total = F.aggregate("by_weight", F.lit(0.0), lambda t, x: t + x["r"])
    before = lambda i: F.aggregate(F.slice("by_weight", F.lit(1), i), F.lit(0.0), lambda t, x: t + x["r"])
    large = large.withColumn("by_weight", by_weight).withColumn("rare", F.transform(F.filter("by_weight", lambda x, i: before(i) <= (1 - ACCEPT) * total + 1e-9), lambda x: x["w"]))
    whole = F.array(F.array_join("words", ""))

    def keyed(words: Column) -> DataFrame:
        return large.withColumn("block", F.explode(F.transform(F.array_distinct(F.flatten(F.transform(F.array_distinct(F.concat(words, whole)), _variants))), lambda v: F.concat_ws("|", "spot", v)))).drop("by_weight", "rare")

    return small.unionByName(keyed(F.col("rare"))).drop("spot", "many"), small.unionByName(keyed(F.col("words"))).drop("spot", "many")


#: Rarity-weighted share of the words that two addresses of a number and town have in common.
ACCEPT = 0.8


def place_pairs(addresses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): (key, place) of every record with an address, and (place_a, place_b) of the places that are the same.

    A place is one spelling of an address; copies of an address are members of it and meet nobody, so a hot address
    costs one row each. Words near one another by a slip count as shared.
    """
    own = materialize(signatures(addresses.where("key IS NOT NULL")).withColumn("place", F.xxhash64(*[F.coalesce(F.array_join(c, " ") if c == "words" else F.col(c), F.lit("\x00")) for c in SIGNATURE])), "signatures")
    distinct = materialize(own.groupBy(*SIGNATURE, "place").agg(F.count("*").alias("n")), "places")
    # rarity of a word over all records
    total = max(1, own.count())
    rare = distinct.select("n", F.explode("words").alias("word")).groupBy("word").agg(F.log(1 + F.lit(float(total)) / F.sum("n")).alias("rarity"))
    weighed = distinct.select("place", F.explode("words").alias("word")).join(rare, "word").groupBy("place").agg(F.map_from_entries(F.collect_set(F.struct("word", "rarity"))).alias("rarity"))
    places = distinct.drop("n").join(weighed, "place", "left").withColumn("rarity", F.coalesce("rarity", F.create_map().cast("map<string,double>")))
    asks, answers = _blocks(places)
    cols = ["place", "town", "state", "dir", "type", "words", "rarity"]
    a = asks.select("block", *[F.col(c).alias(c + "_a") for c in cols])
    b = answers.select("block", *[F.col(c).alias(c + "_b") for c in cols])
    agree = lambda c: F.col(f"{c}_a").isNull() | F.col(f"{c}_b").isNull() | (F.col(f"{c}_a") == F.col(f"{c}_b"))
    pairs = a.join(b, "block").where((F.col("place_a") != F.col("place_b")) & agree("dir") & agree("type") & agree("state"))
    shared = F.array_intersect("words_a", "words_b")
    left, right = F.array_except("words_a", "words_b"), F.array_except("words_b", "words_a")
    near = F.filter(left, lambda w: F.exists(right, lambda v: _near(w, v)))
    lone = F.filter(right, lambda v: ~F.exists(left, lambda w: _near(w, v)))
    weight = lambda words, side: F.aggregate(words, F.lit(0.0), lambda s, w: s + F.coalesce(F.try_element_at(F.col(f"rarity_{side}"), w), F.lit(1.0)))
    joined = _near(F.array_join("words_a", ""), F.array_join("words_b", "")) & (F.size("words_a") > 0) & (F.size("words_b") > 0)
    good = weight(shared, "a") + weight(near, "a")
    every = weight(F.col("words_a"), "a") + weight(lone, "b")
    pairs = pairs.where((F.size("words_a") == 0) & (F.size("words_b") == 0) | joined | ((every > 0) & (good / every >= ACCEPT)))
    pairs = pairs.select(F.least("place_a", "place_b").alias("place_a"), F.greatest("place_a", "place_b").alias("place_b")).distinct()
    return own.select("key", "place"), pairs


def same_places(addresses: DataFrame) -> DataFrame:
    """(rec_a, rec_b): every pair of keys whose addresses denote the same place, rec_a the smaller.

    `addresses` is (key, address, city, state, zip5); city, state and zip5 may be NULL where the address states them
    itself. Rows without a key, an address, a number or a town (stated, or known from the zip) are in no pair; a key
    that stands twice has each of its addresses. Towns of one name in two states are two towns. The pairs of a place
    with very many records are made by several tasks; place_pairs() gives places and members instead of all pairs.
    """
    own, pairs = place_pairs(addresses)
    own = materialize(own.distinct(), "members")
    pairs = materialize(pairs, "pairs")
    links = pairs.unionByName(own.select(F.col("place").alias("place_a"), F.col("place").alias("place_b")).distinct())
    parts = own.groupBy("place").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    a = own.join(parts, "place").select(F.col("place").alias("place_a"), F.col("key").alias("key_a"), "parts", F.pmod(F.xxhash64("key"), "parts").cast("int").alias("part"))
    sized = links.join(parts.withColumnRenamed("place", "place_a"), "place_a").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    left = sized.join(a.drop("parts"), ["place_a", "part"])
    both = left.join(own.select(F.col("place").alias("place_b"), F.col("key").alias("key_b")), "place_b")
    both = both.where(F.when(F.col("place_a") == F.col("place_b"), F.col("key_a") < F.col("key_b")).otherwise(F.col("key_a") != F.col("key_b")))
    return both.select(F.least("key_a", "key_b").alias("rec_a"), F.greatest("key_a", "key_b").alias("rec_b")).distinct()
