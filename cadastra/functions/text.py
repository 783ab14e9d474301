"""Scalar normalizers and parsers over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal suffixes dropped from names, with the word boundary before them only at their start.
LEGAL_SUFFIXES = ["INC", "LLC", "LTD", "CORP", "CO", "PLC", "LP", "LLP", "ASSN", "ASSOC", "ASSOCIATION"]
SUFFIX_PATTERN = r"\b(" + "|".join(LEGAL_SUFFIXES) + r")\b"
STATE_FIPS = {"FL": "12", "NC": "37", "SC": "45", "TX": "48", "PA": "42"}


def normalize_name(c: Column) -> Column:
    """Upper case, legal suffixes out before punctuation, everything else but A-Z, 0-9 to single blanks; '' for NULL."""
    t = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), SUFFIX_PATTERN, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "[^A-Z0-9 ]", " "), r"\s+", " "))


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def normalize_zip(c: Column) -> Column:
    """First five of all digits, '' if there are fewer."""
    return F.when(F.length(digits(c)) >= 5, F.left(digits(c), F.lit(5))).otherwise("")


def normalize_phone(c: Column) -> Column:
    """All digits if there are ten or more, else ''."""
    return F.when(F.length(digits(c)) >= 10, digits(c)).otherwise("")


def int_key(c: Column) -> Column:
    """A whole number's text without decimals, '' if it is none."""
    d = c.try_cast("double")
    return F.coalesce(F.when(~F.isnan(d) & (F.abs(d) < 9.2e18), d.cast("long").cast("string")), F.lit(""))


def clean_id(c: Column) -> Column:
    """Trimmed, a trailing .0 cut, NULL if nothing is left."""
    return F.nullif(F.regexp_replace(F.trim(c), r"\.0+$", ""), F.lit(""))


def zip_from_int(c: Column) -> Column:
    """A zip read as a number, zeros put back in front; longer numbers are cut to five."""
    t = F.coalesce(c.try_cast("bigint").cast("string"), F.lit(""))
    return F.when(t == "", "").when(F.length(t) < 5, F.lpad(t, 5, "0")).otherwise(F.left(t, F.lit(5)))


def fips_of(state: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in STATE_FIPS.items() for x in kv]), state)


def packed_zip(c: Column) -> Column:
    return F.regexp_extract(F.trim(F.coalesce(c, F.lit(""))), r"([0-9]{5})$", 1)


def packed_state(c: Column) -> Column:
    return F.regexp_extract(F.trim(F.coalesce(c, F.lit(""))), r"\b([A-Z]{2})\s+[0-9]{5}$", 1)


def _packed_parts(c: Column) -> Column:
    rest = F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"\b[A-Z]{2}\s+[0-9]{5}$", "")
    return F.transform(F.split(F.regexp_replace(rest, "[ ,]+$", ""), ","), lambda p: F.trim(p))


def packed_city(c: Column) -> Column:
    """The part before 'ST ZIP' of 'Street, City, ST ZIP'."""
    return F.element_at(_packed_parts(c), -1)


def packed_street(c: Column) -> Column:
    p = _packed_parts(c)
    return F.when(F.size(p) <= 1, F.element_at(p, 1)).otherwise(F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), ", "))


def packed_phone(c: Column) -> Column:
    """What stands after 'Phone:' up to a comma or an 'or', if that is digits and phone punctuation; else ''."""
    after = F.get(F.split(F.coalesce(c, F.lit("")), "(?i)phone:", 2), F.lit(1))
    first = F.trim(F.get(F.split(after, r"(?i),|\sor\s"), F.lit(0)))
    return F.when(F.translate(first, "0123456789-() ", "") == "", first).otherwise("")


def certificate_ids(url: Column) -> Column:
    """struct(id, kind) of .../certificates/{digits}/{id}/{kind}/."""
    p = r"/certificates/[0-9]+/([^/]+)/([^/]+)/"
    return F.struct(F.nullif(F.regexp_extract(url, p, 1), F.lit("")).alias("certificate_id"), F.nullif(F.regexp_extract(url, p, 2), F.lit("")).alias("kind"))


def mailto_emails(html: Column) -> Column:
    """Addresses of mailto links in order, lower case, without query, each once, no-reply ones left out."""
    found = F.regexp_extract_all(html, F.lit(r"(?i)href\s*=\s*[\"']mailto:([^\"'?]+)"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda e: F.lower(F.trim(e))), lambda e: ~e.rlike("^(noreply|no-reply|donotreply|do-not-reply)@")))


def first_email(c: Column) -> Column:
    """The first e-mail address of a text, NULL without one."""
    return F.nullif(F.regexp_extract(c, r"[\w.%+-]+@(?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,}", 0), F.lit(""))


def first_phone(c: Column) -> Column:
    """The first stretch of digits and phone punctuation that has ten digits, or eleven after a 1; NULL without one."""
    stretches = F.regexp_extract_all(c, F.lit(r"[(+]?[0-9][0-9(). \t+-]{8,}[0-9]"), F.lit(0))
    bare = lambda x: F.regexp_replace(x, "[^0-9]", "")
    return F.get(F.filter(stretches, lambda x: (F.length(bare(x)) == 10) | ((F.length(bare(x)) == 11) & F.startswith(bare(x), F.lit("1")))), F.lit(0))


def place_score(name: Column, city: Column, state: Column, zip5: Column, display: Column, address: Column) -> Column:
    """How well a place found by name fits: 4 a significant shared word, 3 the zip, 3 the city, 2 the state."""
    words = F.filter(F.split(F.upper(name), " "), lambda w: F.length(w) > 3)
    at = F.upper(address)
    hit = lambda c, n: F.when((c != "") & F.contains(at, F.upper(c)), n).otherwise(0)
    return F.when(F.arrays_overlap(words, F.split(F.upper(display), " ")), 4).otherwise(0) + hit(city, 3) + hit(state, 2) + hit(zip5, 3)
