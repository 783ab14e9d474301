"""Landed sources to the canonical 21 columns, by declaration."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadastra.functions.text import normalize_name, normalize_phone, normalize_zip

CANONICAL = ["source_id", "natural_key", "vertical", "account_type", "name_raw", "name_normalized", "address_line_1", "city", "state", "zip5", "phone_raw", "phone_normalized", "latitude", "longitude", "segment", "ein", "county_fips", "size_metric", "size_value", "size_unit", "source_file"]
NUMBERS = {"latitude", "longitude", "size_value"}
STATES = ["FL", "NC", "SC", "TX", "PA"]


@dataclass(frozen=True)
class SourceSpec:
    """Where a source's columns come from. `columns` maps canonical names to a raw column name or an expression of the frame."""

    source_id: str
    vertical: str
    columns: dict[str, str | Callable[[DataFrame], Column]] = field(default_factory=dict)
    states: Sequence[str] | None = None
    where: Callable[[DataFrame], Column] | None = None


def canonical(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """`df` in the canonical columns: names, zips and phones normalized, numbers cast (bad ones and NaN NULL), the rest text, missing columns NULL."""
    if spec.where:
        df = df.where(spec.where(df))
    def of(name: str) -> Column:
        c = spec.columns.get(name)
        if c is None:
            return F.lit(None).cast("string")
        return F.col(c) if isinstance(c, str) else c(df)

    raw = {n: of(n) for n in CANONICAL}
    raw |= {"source_id": F.lit(spec.source_id), "vertical": F.lit(spec.vertical)}
    if "name_normalized" not in spec.columns:
        raw["name_normalized"] = normalize_name(raw["name_raw"])
    if "phone_normalized" not in spec.columns:
        raw["phone_normalized"] = normalize_phone(raw["phone_raw"])
    raw["zip5"] = normalize_zip(raw["zip5"].cast("string"))
    num = lambda c: F.nanvl(c.cast("string").try_cast("double"), F.lit(None).cast("double"))
    out = df.select(*[(num(c) if n in NUMBERS else c.cast("string")).alias(n) for n, c in raw.items()])
    return out.where(F.col("state").isin(*spec.states)) if spec.states else out


def read_csv(spark: SparkSession, paths: str | list[str], columns: Sequence[str] | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Text columns only, blanks kept as blanks, plus source_file; `columns` prunes the scan."""
    df = spark.read.option("header", True).option("inferSchema", False).option("encoding", encoding).option("emptyValue", "").option("nullValue", "\x00").option("multiLine", True).option("escape", '"').csv(paths)
    df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df.select(*columns, "source_file") if columns else df


def header_names(df: DataFrame) -> DataFrame:
    """Headers trimmed, lower case, blanks as underscores."""
    return df.toDF(*["_".join(c.strip().lower().split()) for c in df.columns])


def find_column(df: DataFrame, hints: Sequence[str]) -> str | None:
    """The first column whose name holds one of `hints`, hints in order."""
    return next((c for h in hints for c in df.columns if h.lower() in c.lower()), None)


FEATURE = T.StructType([T.StructField("properties", T.MapType(T.StringType(), T.StringType())), T.StructField("attributes", T.MapType(T.StringType(), T.StringType())), T.StructField("geometry", T.StringType())])


def read_features(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per landed feature of a JSON-lines file: props (upper-cased names), geometry text, lon and lat of points."""
    df = spark.read.text(paths).where(F.trim("value") != "").select(F.from_json("value", FEATURE).alias("f"), F.get_json_object("value", "$.geometry").alias("geometry"))
    props = F.transform_keys(F.coalesce("f.properties", "f.attributes"), lambda k, _: F.upper(k))
    point = F.get_json_object("geometry", "$.type") == "Point"
    at = lambda i, esri: F.coalesce(F.when(point, F.get_json_object("geometry", f"$.coordinates[{i}]")), F.get_json_object("geometry", f"$.{esri}")).try_cast("double")
    return df.select(props.alias("props"), "geometry", at(0, "x").alias("lon"), at(1, "y").alias("lat"))


def read_pages(spark: SparkSession, paths: str | list[str], rows: str = "results") -> DataFrame:
    """Rows of landed API pages {"results": [{...}, ...]}, each a map of texts."""
    page = spark.read.option("wholetext", True).text(paths)
    items = F.from_json(F.get_json_object("value", f"$.{rows}"), "array<map<string,string>>")
    return page.select(F.explode(items).alias("row"))


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def land(content: bytes, root: str, source_id: str, day: str, extension: str) -> str:
    """Write raw bytes gzipped under their digest; a payload that is there already isn't written again. Returns the path."""
    import gzip
    import hashlib
    import os

    path = os.path.join(root, source_id, day, f"{hashlib.sha256(content).hexdigest()}.{extension}.gz")
    if not os.path.exists(path):
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path + ".part", "wb") as f:
            f.write(gzip.compress(content, mtime=0))
        os.replace(path + ".part", path)
    return path
