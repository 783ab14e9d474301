"""Row filters, lookups and flags that route a source's rows, as column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prefixes of facility taxonomies, and the words by which a licensee's name is an association's.
FACILITY_PREFIXES = ["261Q", "282", "284", "285", "286", "287"]
ASSOCIATION_WORDS = r"(?i)ASSOCIATION|ASSN|ASSOC|CONDOMINIUM|\bCOA\b|\bHOA\b|OWNERS"


def _false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def cemetery_organization(subsection: Column, activity: Column) -> Column:
    """Subsection 13, or an activity code of Y50; a NULL code is none."""
    return _false(F.trim(subsection) == "13") | _false(activity.startswith("Y50"))


def any_prefix(columns: Sequence[Column], prefixes: Sequence[str] = FACILITY_PREFIXES) -> Column:
    """Does any of the columns start with any of the prefixes? NULLs start with none."""
    return _false(F.exists(F.array(*columns), lambda c: _false(reduce(or_, [c.startswith(p) for p in prefixes]))))


def first_present(columns: Sequence[Column], default: str = "") -> Column:
    """The first column that isn't blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns], F.lit(default))


def looked_up(c: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """A value's entry in a small fixed table, else the default."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), F.lit(default))


def association_name(c: Column) -> Column:
    return _false(c.rlike(ASSOCIATION_WORDS))


def segment_of(kind: Column, operating: Column) -> Column:
    """religious or municipal by a cemetery's type, municipal by a public operator; NULL where other tables must tell."""
    t, o = F.upper(F.coalesce(kind, F.lit(""))), F.upper(F.coalesce(operating, F.lit("")))
    return F.when(F.contains(t, F.lit("RELIGIOUS")), "religious").when(F.contains(t, F.lit("MUNICIPAL")) | (o == "PUBLIC"), "municipal")


def resolved_segment(segment: Column, exempt: Column, federal: Column) -> Column:
    """A segment that is stated stays; else an exempt organization is religious, a federal account federal, the rest municipal."""
    return F.coalesce(F.nullif(F.trim(segment), F.lit("")), F.when(_false(exempt), "religious").when(_false(federal), "federal").otherwise("municipal"))


def county_parts(c: Column, junk: Sequence[str] = ()) -> Column:
    """struct(usable, several, primary) of a county field: junk and bare numbers aren't usable, '/', '&' or AND join several, the first is primary."""
    t = F.upper(F.trim(c))
    usable = t.isNotNull() & ~_false(t.isin(*junk) if junk else F.lit(False)) & ~_false(t.rlike("^[0-9]+$"))
    between = r"[/&]|\bAND\b"
    return F.struct(usable.alias("usable"), _false(t.rlike(between)).alias("several"), F.when(usable, F.trim(F.get(F.split(t, between), F.lit(0)))).alias("primary"))


def in_county(c: Column, county: str) -> Column:
    """County equality in any case and spacing."""
    return _false(F.upper(F.trim(c)) == county.strip().upper())


def encoded_url(c: Column) -> Column:
    """A link whose path may hold blanks and '#': every part of the path percent-encoded, so that nothing is taken for a fragment."""
    head = F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/#]*)", 1)
    path = F.substr(c, F.length(head) + 1)
    one = lambda p: F.replace(F.url_encode(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B")))), F.lit("+"), F.lit("%20"))
    return F.when(head == "", c).otherwise(F.concat(head, F.array_join(F.transform(F.split(path, "/"), one), "/")))


def numbered_locations(df: DataFrame, owner: str, order: Sequence[Column | str], keep: Column | None = None) -> DataFrame:
    """`df` with location_seq, 1 from an owner's first row on, and natural_key owner|seq; `keep` drops rows after the numbering, so it never shifts."""
    from pyspark.sql import Window

    out = df.withColumn("location_seq", F.row_number().over(Window.partitionBy(owner).orderBy(*order)).cast("long"))
    out = out.withColumn("natural_key", F.concat_ws("|", F.col(owner).cast("string"), F.col("location_seq").cast("string")))
    return out if keep is None else out.where(keep)


def funnel(df: DataFrame, steps: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that pass all steps in turn, one row of counts after each step), the counts in a single pass."""
    passed, counts = F.lit(True), [F.count("*").alias("all_rows")]
    for name, test in steps.items():
        passed = passed & _false(test)
        counts.append(F.count_if(passed).alias(name))
    return df.where(passed), df.agg(*counts)


def collapsed(df: DataFrame, key: str, order: Column, largest: str, columns: Sequence[str]) -> DataFrame:
    """One row a key: each column's first value that isn't NULL in `order`, the largest (never the sum) of `largest`, and unit_rows."""
    picks = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns]
    return df.groupBy(key).agg(*picks, F.max(largest).alias(largest), F.count("*").alias("unit_rows"))
