"""Record linkage: exact tiers, blocked fuzzy pairs, connected components, survivorship."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.similarity import ScoreSpec, compound_bound, compound_name_similarity, known_score
from cadastra.functions.text import normalize_name, normalize_phone, normalize_zip
from cadastra.runtime import absent, discard, materialize

# Names shared by many distinct places, never merged by name.
CHAINS = ["HCA HEALTHCARE", "ASCENSION HEALTH", "COMMONSPIRIT HEALTH", "ADVENT HEALTH", "TENET HEALTHCARE", "COMMUNITY HEALTH SYSTEMS"]


def tier1(df: DataFrame, ids: Sequence[str] = ("ccn", "npi")) -> Column:
    """cluster_id by the first present identifier, else src:source:key."""
    out = F.concat_ws(":", F.lit("src"), "source_id", "natural_key")
    for name in reversed([i for i in ids if i in df.columns]):
        out = F.when(~absent(F.col(name)), F.concat(F.lit(f"{name}:"), F.trim(F.col(name)))).otherwise(out)
    return out


def tier2(df: DataFrame, name: str = "name", zip5: str = "zip5", state: str = "state") -> DataFrame:
    """Unmerged rows of one name, zip and state, two or more, share cluster_id t2:...; blank parts match as blanks.

    Groups are counted by an aggregate and joined back, so a hot group is never one task's rows.
    """
    own = F.col("cluster_id").startswith("src:")
    open_rows = own & ~F.col(name).isin(CHAINS)
    key = F.concat(F.lit("t2:"), F.coalesce(F.col(name), F.lit("")), F.lit("|"), F.coalesce(F.col(zip5), F.lit("")), F.lit("|"), F.coalesce(F.col(state), F.lit("")))
    keyed = df.withColumn("_k", F.when(open_rows, key))
    groups = keyed.where("_k IS NOT NULL").groupBy("_k").count().where("count > 1").select("_k", F.lit(True).alias("_pair"))
    return keyed.join(groups, "_k", "left").withColumn("cluster_id", F.when(F.col("_pair"), F.col("_k")).otherwise(F.col("cluster_id"))).drop("_k", "_pair")


def fuzzy_pairs(df: DataFrame, *, queue: float = 0.75, spec: ScoreSpec = ScoreSpec(), near_km: float = 0.38) -> DataFrame:
    """(a_id, b_id, score) of pairs scoring at least `queue`, a_id the smaller.

    `df` is (id, name, address, phone, state, zip5, latitude, longitude, size_value). Two records are compared if they share
    state, zip and name prefix, or state and phone, or a 1-degree cell. The last is quadratic in a cell; but a pair that
    shares nothing else can reach 0.75 only within 375 m or with one phone, so the cell is replaced by fine cells
    and their neighbours, and by cell and phone, and the same-cell test kept. Below 0.75 the whole cell is used. Pairs that can't
    reach `queue` even with equal names and addresses are dropped before any string is compared.
    """
    step = near_km / 111.19
    wide = step / 0.7
    cell = F.concat_ws(",", F.floor("latitude").cast("string"), F.floor("longitude").cast("string"))
    placed = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    phone = normalize_phone(F.col("phone"))
    prefix = F.left(F.coalesce("name", F.lit("")), F.lit(4))
    # two blank names score nothing, so by them alone no pair reaches what the other features add up to
    named = (normalize_name(F.col("name")) != "") | F.lit(queue <= 1 - spec.name)
    base = [
        F.when(named, F.concat_ws(":", F.lit("szn"), F.coalesce("state", F.lit("")), normalize_zip(F.col("zip5")), prefix)),
        F.when(phone != "", F.concat_ws(":", F.lit("sph"), F.coalesce("state", F.lit("")), phone)),
    ]
    y, x = F.floor(F.col("latitude") / step), F.floor(F.col("longitude") / wide)
    fine = lambda dy, dx: F.when(placed, F.concat_ws(":", F.lit("geo"), (y + dy).cast("string"), (x + dx).cast("string")))
    if queue >= 0.75:
        base.append(F.when(placed & (phone != ""), F.concat_ws(":", F.lit("gph"), cell, phone)))
        around = [*base, *[fine(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]]
        own = [*base, fine(0, 0)]
    else:
        around = own = [*base, F.when(placed, F.concat(F.lit("geo:"), cell))]
    # normalized once a record, not once a pair
    ready = df.select("id", normalize_name(F.col("name")).alias("name"), normalize_name(F.col("address")).alias("address"), normalize_phone(F.col("phone")).alias("phone"), "latitude", "longitude", "size_value", cell.alias("cell"), _blocks(own).alias("own"), _blocks(around).alias("around"))
    ready = materialize(ready, "ready")
    cols = ["id", "name", "address", "phone", "latitude", "longitude", "size_value", "cell"]
    a = ready.select(*[F.col(c).alias("a_" + c) for c in cols], F.col("own").alias("a_keys"), F.explode("own").alias("block"))
    b = ready.select(*[F.col(c).alias("b_" + c) for c in cols], F.col("around").alias("b_keys"), F.explode("around").alias("block"))
    # a's own blocks meet b's blocks and their neighbours; that is the same whichever of the two is a, so one order does.
    # A pair of several blocks is taken from the first they share.
    pairs = a.join(b, "block").where((F.col("a_id") < F.col("b_id")) & (F.get(F.array_intersect("a_keys", "b_keys"), F.lit(0)) == F.col("block")))
    whole_cell = F.exists(F.array_intersect("a_keys", "b_keys"), lambda k: ~F.startswith(k, F.lit("g"))) | (F.col("a_cell") == F.col("b_cell"))
    pairs = pairs.where(whole_cell).drop("block", "a_keys", "b_keys", "a_cell", "b_cell")
    pairs = pairs.withColumn("known", known_score(spec))
    # what the strings could add at most: by their lengths, and by nothing at all where one is blank
    name_most, street_most = compound_bound(F.col("a_name"), F.col("b_name")), compound_bound(F.col("a_address"), F.col("b_address"))
    able = pairs.where(F.col("known") + spec.name * name_most + spec.address * street_most >= queue - 1e-9)
    name = compound_name_similarity(F.col("a_name"), F.col("b_name"))
    # the second string is compared only where the first left a chance
    able = materialize(able.withColumn("named", spec.name * name).where(F.col("named") + F.col("known") + spec.address * street_most >= queue - 1e-9), "able")
    street = compound_name_similarity(F.col("a_address"), F.col("b_address"))
    return able.select("a_id", "b_id", (F.col("named") + spec.address * street + F.col("known")).alias("score")).where(F.col("score") >= queue)


def _blocks(keys: list[Column]) -> Column:
    return F.array_distinct(F.filter(F.array(*keys), lambda k: k.isNotNull()))


def tier3(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(id, cluster_id): every row of (id, natural_key) named after the smallest natural key that `links` (a_id, b_id) join it to, a row alone after its own."""
    joined = rows.join(components(links, "a_id", "b_id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = joined.groupBy("component").agg(F.concat(F.lit("t3:"), F.min("natural_key")).alias("cluster_id"))
    return joined.join(least, "component").select("id", "cluster_id")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every end of `links`: the smallest end of its component.

    Each round every vertex takes the least label among itself and its neighbours, then its label's label, until
    nothing changes; the rounds grow with the logarithm of the diameter. Labels are written every round.
    """
    e = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    arcs = materialize(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "arcs")
    labels = materialize(arcs.groupBy(F.col("u").alias("id")).agg(F.least(F.col("id"), F.min("v")).alias("component")), "labels")
    while True:
        heard = arcs.join(labels.select(F.col("id").alias("u"), F.col("component").alias("c")), "u").groupBy(F.col("v").alias("id")).agg(F.min("c").alias("c"))
        step = labels.join(heard, "id", "left").select("id", F.col("component").alias("was"), F.least("component", F.coalesce("c", "component")).alias("component"))
        jump = step.select(F.col("id").alias("component"), F.col("component").alias("further"))
        nxt = materialize(step.join(jump, "component", "left").select("id", "was", F.least("component", F.coalesce("further", "component")).alias("component")), "labels")
        same = nxt.where("was <> component").isEmpty()
        discard(labels)
        labels = nxt.drop("was")
        labels._cadastra_path = nxt._cadastra_path
        if same:
            return labels


def survivors(df: DataFrame, cluster: str, columns: Sequence[str], rank: Column, order: Column, key: Column) -> DataFrame:
    """One row per cluster: each column's first present value by rank and order, latitude with its longitude, and the members.

    merged_sources lists the members' keys in order, each once.
    """
    at = F.struct(rank.alias("r"), order.alias("o"))
    rows = df.withColumn("_at", at).withColumn("_key", key)
    picks = [F.min_by(F.col(c), F.when(~absent(F.col(c).cast("string")), F.col("_at"))).alias(c) for c in columns]
    both = F.min_by(F.struct("latitude", "longitude"), F.when(F.col("latitude").isNotNull() & ~F.isnan("latitude"), F.col("_at"))).alias("_p")
    out = rows.groupBy(cluster).agg(*picks, both, F.array_sort(F.collect_set(F.struct("_at", "_key"))).alias("_m"))
    return out.select(cluster, *columns, F.col("_p.latitude").alias("latitude"), F.col("_p.longitude").alias("longitude"), F.array_join(F.transform("_m", lambda m: m["_key"]), ",").alias("merged_sources"), F.size("_m").cast("long").alias("members"))
