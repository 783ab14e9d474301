"""Name and pair similarity."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions.geo import haversine_km
from cadastra.functions.text import normalize_name, normalize_phone


def name_similarity(a: Column, b: Column) -> Column:
    """1 - levenshtein / longer length after trimming; 0 if either is blank."""
    x, y = F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))
    return F.when((x == "") | (y == ""), 0.0).otherwise(1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y)))


def _jaro_winkler(a: str, b: str) -> float:
    """Jaro by the places of each letter in `b`: every letter of `a` takes the first free one within reach."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    places: dict[str, list[int]] = {}
    for j, letter in enumerate(b):
        places.setdefault(letter, []).append(j)
    taken, left = [], []
    for i, letter in enumerate(a):
        free = places.get(letter)
        # places only fall behind as i grows, so what is out of reach on the left never comes back
        while free and free[0] < i - reach:
            free.pop(0)
        if free and free[0] <= i + reach:
            taken.append(free.pop(0))
            left.append(letter)
    if not left:
        return 0.0
    m = len(left)
    swaps = sum(letter != b[j] for letter, j in zip(left, sorted(taken))) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + 0.1 * prefix * (1 - jaro)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler, prefix of up to four letters, boosted above 0.7 only; each distinct pair is computed once a batch."""
    pairs = list(zip(a.fillna(""), b.fillna("")))
    known = {p: _jaro_winkler(*p) for p in set(pairs)}
    return pd.Series([known[p] for p in pairs], dtype="float64")


def _grams(c: Column) -> Column:
    return F.when(F.length(c) >= 3, F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.substring(c, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared character trigrams, with their counts, over the larger number of trigrams; 0 below three letters."""
    x, y = _grams(F.coalesce(a, F.lit(""))), _grams(F.coalesce(b, F.lit("")))
    count = lambda grams, g: F.size(F.filter(grams, lambda v: v == g))
    common = F.array_intersect(x, y)
    # a trigram counts as often as both have it, which is once unless both repeat some
    single = (F.size(F.array_distinct(x)) == F.size(x)) | (F.size(F.array_distinct(y)) == F.size(y))
    shared = F.when(single, F.size(common)).otherwise(F.aggregate(common, F.lit(0), lambda s, g: s + F.least(count(x, g), count(y, g))))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(shared / F.greatest(F.size(x), F.size(y)))


def _shared_letters(a: Column, b: Column) -> Column:
    """Letters of `a` that stand in `b`, at most as many as the shorter text has: no more can match."""
    kept = lambda p, q: F.length(p) - F.length(F.call_function("translate", p, q, F.lit("")))
    return F.least(kept(a, b), kept(b, a))


def compound_bound(a: Column, b: Column) -> Column:
    """What compound_name_similarity can't exceed: by their lengths, and by the letters and digits they have in common."""
    x, y = F.length(a), F.length(b)
    short, long = F.least(x, y), F.greatest(x, y)
    shared = _shared_letters(a, b)
    jaro = F.when(shared == 0, 0.0).otherwise((shared / x + shared / y + 1) / 3)
    winkler = F.when(jaro <= 0.7, jaro).otherwise(jaro + 0.4 * (1 - jaro))
    grams = F.greatest(short - 2, F.lit(0)) / F.greatest(long - 2, F.lit(1))
    return F.when((x == 0) | (y == 0) | a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).otherwise(0.6 * winkler + 0.4 * grams)


def compound_name_similarity(a: Column, b: Column) -> Column:
    return 0.6 * jaro_winkler(a, b) + 0.4 * trigram_similarity(a, b)


@dataclass(frozen=True)
class ScoreSpec:
    """Weights of a pair's features; they sum to 1."""

    name: float = 0.35
    address: float = 0.30
    spatial: float = 0.20
    phone: float = 0.10
    size: float = 0.05


def pair_score(spec: ScoreSpec = ScoreSpec(), a: str = "a_", b: str = "b_") -> Column:
    """Weighted score of two records' columns name, address, phone, latitude, longitude, size_value behind prefixes."""
    x, y = (lambda c: F.col(a + c)), (lambda c: F.col(b + c))
    name = compound_name_similarity(normalize_name(x("name")), normalize_name(y("name")))
    street = compound_name_similarity(normalize_name(x("address")), normalize_name(y("address")))
    return spec.name * name + spec.address * street + known_score(spec, a, b)


def known_score(spec: ScoreSpec = ScoreSpec(), a: str = "a_", b: str = "b_") -> Column:
    """The part of pair_score that costs no string comparison."""
    x, y = (lambda c: F.col(a + c)), (lambda c: F.col(b + c))
    km = haversine_km(x("latitude"), x("longitude"), y("latitude"), y("longitude"))
    spatial = F.coalesce(F.greatest(F.lit(0.0), 1 - km / 0.5), F.lit(0.0))
    pa, pb = normalize_phone(x("phone")), normalize_phone(y("phone"))
    phone = F.when((pa != "") & (pa == pb), 1.0).otherwise(0.0)
    larger = F.greatest(x("size_value"), y("size_value"))
    size = F.when(x("size_value").isNull() | y("size_value").isNull() | (larger == 0), 0.0).when(F.abs(x("size_value") - y("size_value")) / larger < 0.2, 1.0).otherwise(0.0)
    return spec.spatial * spatial + spec.phone * phone + spec.size * size
