"""Best representative of each duplicate group: field values fused over sources, or picked by stated precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.runtime import broadcast_if_small, materialize


def usable_acres(c: Column) -> Column:
    return F.coalesce((c > 0) & ~F.isnan(c), F.lit(False))


def usable_phone(c: Column) -> Column:
    """At least ten digits that aren't all the same."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.coalesce((F.length(digits) >= 10) & ~digits.rlike(r"^([0-9])\1*$"), F.lit(False))


def surviving_records(members: DataFrame, ranks: DataFrame, fields: dict[str, Column], *, group: str = "cluster_id", key: str = "record_key", source: str = "source_id", stamp: str = "loaded_at", rank: str = "trust_rank", min_members: int = 2) -> DataFrame:
    """(group, field_name, record key): per group and field the member whose usable value survives.

    `fields` maps a name to its test of usability. The survivor has the lowest trust rank (sources without a
    rank last), then the latest stamp (NULL last), then the smallest key. `members` hold one current row per key;
    groups of fewer than `min_members` keys, members with a NULL group or key, and fields without a usable value
    yield nothing. One aggregate, combined before the shuffle, whatever a group's size; repeated rank rows count once.
    """
    lowest = ranks.groupBy(F.col(source).alias("_source")).agg(F.min(rank).alias("_rank"))
    rows = members.where(F.col(group).isNotNull() & F.col(key).isNotNull())
    rows = rows.join(broadcast_if_small(lowest, 1 << 20), rows[source] == lowest["_source"], "left")
    late = F.coalesce(-F.unix_micros(F.col(stamp).cast("timestamp")), F.lit((1 << 63) - 1))
    order = F.struct(F.coalesce(F.col("_rank"), F.lit((1 << 31) - 1)).alias("r"), late.alias("t"), F.col(key).alias("k"))
    best = rows.groupBy(group).agg(F.count("*").alias("_n"), *[F.min(F.when(test, order)).alias(name) for name, test in fields.items()])
    told = F.array(*[F.struct(F.lit(name).alias("field_name"), F.col(name)["k"].alias(key)) for name in fields])
    return best.where(F.col("_n") >= min_members).select(group, F.inline(F.filter(told, lambda x: x[key].isNotNull())))


def _score(c: Column) -> Column:
    return F.log(c / (1 - c))


def fused_values(claims: DataFrame, *, priors: DataFrame | None = None, rounds: int = 20, tolerance: float = 0.001, prior_accuracy: float = 0.8, false_values: int = 10, copy_prior: float = 0.1, copy_rate: float = 0.8) -> DataFrame:
    """Bayesian fusion with copy detection.

    `claims` is (grp, field, source, value): what each source says of each field of a group; a source saying
    several values of one item counts with each. Returns (grp, field, value, probability, sources): the value of
    highest posterior probability, ties to the smaller value.

    Each round scores a value by the log odds of its sources' accuracies, lowered for a source by the probability
    that it copied that value from another; turns scores into probabilities; takes a source's accuracy as the mean
    probability of its claims; and finds dependence between two sources from how often they agree on values held
    false, agree on values held true, and differ. Only source-level tables (sources, pairs of sources) travel to
    every task, each behind a check of its size. It stops when no source's accuracy moves by `tolerance`, after `rounds`
    rounds at most. `priors` (source, accuracy) are the accuracies to start from; a source without one starts at
    `prior_accuracy`. NULL groups, fields, sources and values are no claims.
    """
    for c in ("grp", "field", "source", "value"):
        claims = claims.where(F.col(c).isNotNull())
    # one row per item and value with its sources: repeats are gone before anything is joined
    votes = materialize(claims.groupBy("grp", "field", "value").agg(F.array_sort(F.collect_set("source")).alias("sources")), "votes")
    accuracy = votes.select(F.explode("sources").alias("source")).distinct()
    accuracy = accuracy.withColumn("accuracy", F.lit(prior_accuracy)) if priors is None else accuracy.join(broadcast_if_small(priors.groupBy("source").agg(F.max("accuracy").alias("accuracy"))), "source", "left").withColumn("accuracy", F.coalesce("accuracy", F.lit(prior_accuracy)))
    accuracy = materialize(accuracy, "accuracy")
    dependence = None
    for _ in range(rounds):
        each = votes.select("grp", "field", "value", "sources", F.explode("sources").alias("source"))
        if dependence is None:
            each = each.withColumn("own", F.lit(1.0))
        else:
            # a source's vote counts for the chance that it copied from none of the value's other sources before it
            pairs = each.select("grp", "field", "value", "source", F.explode("sources").alias("other")).where("other < source")
            pairs = pairs.join(broadcast_if_small(dependence), ["source", "other"])
            own = pairs.groupBy("grp", "field", "value", "source").agg(F.exp(F.sum(F.log(1 - copy_rate * F.col("copies")))).alias("own"))
            each = each.join(own, ["grp", "field", "value", "source"], "left").withColumn("own", F.coalesce("own", F.lit(1.0)))
        scored = each.join(broadcast_if_small(accuracy), "source").groupBy("grp", "field", "value").agg(
            F.sum(F.col("own") * (_score(F.col("accuracy")) + F.log(F.lit(float(false_values))))).alias("score"), F.first("sources").alias("sources"))
        # log-sum-exp as two aggregates, so that an item of many values is never one task's list
        tops = scored.groupBy("grp", "field").agg(F.max("score").alias("top"), F.count("*").alias("n"))
        above = scored.join(tops, ["grp", "field"]).withColumn("mass", F.exp(F.col("score") - F.col("top")))
        unsaid = F.greatest(F.lit(0.0), F.lit(float(false_values)) + 1 - F.col("n")) * F.exp(-F.col("top"))
        total = above.groupBy("grp", "field").agg((F.sum("mass") + F.first(unsaid)).alias("total"))
        found = materialize(above.join(total, ["grp", "field"]).select("grp", "field", "value", "sources", (F.col("mass") / F.col("total")).alias("probability")), "fusion")
        said = found.select(F.explode("sources").alias("source"), "probability")
        before = accuracy.withColumnRenamed("accuracy", "_was")
        accuracy = materialize(said.groupBy("source").agg(F.least(F.lit(0.95), F.greatest(F.lit(0.05), F.avg("probability"))).alias("accuracy")), "accuracy")
        moved = accuracy.join(before, "source").agg(F.max(F.abs(F.col("accuracy") - F.col("_was")))).first()[0]
        dependence = materialize(_dependence(found, accuracy, false_values, copy_prior, copy_rate), "dependence")
        if moved is None or moved < tolerance:
            break
    order = F.struct(-F.col("probability"), F.col("value"))
    return found.groupBy("grp", "field").agg(F.min_by(F.struct("value", "probability", "sources"), order).alias("best")).select("grp", "field", "best.*")


def _dependence(found: DataFrame, accuracy: DataFrame, false_values: int, copy_prior: float, copy_rate: float) -> DataFrame:
    """(source, other, copies): probability that one copied the other, from shared true, shared false and different values."""
    pair = F.explode(F.flatten(F.transform("sources", lambda a: F.transform(F.filter("sources", lambda b: b < a), lambda b: F.struct(a.alias("source"), b.alias("other"))))))
    agree = found.select("probability", pair.alias("p")).groupBy("p.source", "p.other").agg(F.sum("probability").alias("true_same"), F.sum(1 - F.col("probability")).alias("false_same"))
    heard = found.select("grp", "field", F.explode("sources").alias("source")).groupBy("grp", "field").agg(F.array_sort(F.collect_set("source")).alias("sources"))
    both = heard.select(pair.alias("p")).groupBy("p.source", "p.other").agg(F.count("*").alias("n"))
    a = accuracy.select("source", F.col("accuracy").alias("a1"))
    b = accuracy.select(F.col("source").alias("other"), F.col("accuracy").alias("a2"))
    t = both.join(agree, ["source", "other"], "left").na.fill(0.0, ["true_same", "false_same"]).join(a, "source").join(b, "other")
    a1, a2, c, n = F.col("a1"), F.col("a2"), copy_rate, float(false_values)
    differ = F.greatest(F.lit(0.0), F.col("n") - F.col("true_same") - F.col("false_same"))
    pt, pf = a1 * a2, (1 - a1) * (1 - a2) / n
    pd = F.greatest(F.lit(1e-6), 1 - pt - pf)
    mean = (a1 + a2) / 2
    log_ratio = (
        F.col("true_same") * F.log((c * mean + (1 - c) * pt) / pt)
        + F.col("false_same") * F.log((c * (1 - mean) + (1 - c) * pf) / pf)
        + differ * F.log(F.lit(1 - c))
    )
    odds = F.log(F.lit(copy_prior / (1 - copy_prior))) + log_ratio
    return t.select("source", "other", (1 / (1 + F.exp(-F.least(F.lit(50.0), F.greatest(F.lit(-50.0), odds))))).alias("copies"))
