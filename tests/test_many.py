import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.functions.many import jaro_winkler_of, trigrams_of
from cadastra.functions.similarity import _jaro_winkler, trigram_similarity
from cadastra.operators import blocked


def texts(n, seed):
    dice = random.Random(seed)
    some = ["", "A", "AB", "ABC", "AAAA", "AAA", "MARTHA", "MARHTA", "É1 ÜX", "X" * 70, "AB " * 30, "THE OAK CLINIC " * 5, "A" * 64, "AB" * 32]
    return some + ["".join(dice.choice("ABCD 1") for _ in range(dice.randint(1, 40))) for _ in range(n)]


def test_many_pairs_as_one_by_one(spark):
    a, b = texts(60, 1), texts(50, 2)
    ia, ib = (x.ravel() for x in np.meshgrid(np.arange(len(a)), np.arange(len(b)), indexing="ij"))
    assert jaro_winkler_of(a, b, ia, ib).tolist() == [_jaro_winkler(a[i], b[j]) for i, j in zip(ia, ib)]
    df = spark.createDataFrame([(int(k), a[i], b[j]) for k, (i, j) in enumerate(zip(ia, ib))], "k long, a string, b string")
    want = [r.v for r in df.select("k", trigram_similarity(F.col("a"), F.col("b")).alias("v")).orderBy("k").collect()]
    assert trigrams_of(a, b, ia, ib).tolist() == want
    none = np.array([], dtype=np.int64)
    assert len(jaro_winkler_of(a, b, none, none)) == len(trigrams_of(a, b, none, none)) == len(jaro_winkler_of([], [], none, none)) == 0


@pytest.mark.parametrize("part, at_once", [(128, 100_000), (3, 7)])
def test_every_pair_of_a_shared_block_once(spark, monkeypatch, part, at_once):
    monkeypatch.setattr(blocked, "PART", part)
    monkeypatch.setattr(blocked, "PAIRS", at_once)
    dice = random.Random(5)
    side = lambda p: [(f"{p}{i}", f"NAME {i % 9}", dice.choice("xyz"), dice.choice(["p", "q", None, None]), dice.choice(["hot", "hot", "c", None])) for i in range(60)]
    a, b = side("a"), side("b")
    schema = "key string, text string, one string, two string, three string"
    got = blocked.compared_pairs(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["one", "two", "three"], jaro_winkler_of).collect()
    want = {(x[0], y[0], _jaro_winkler(x[1], y[1])) for x in a for y in b if any(x[k] is not None and x[k] == y[k] for k in (2, 3, 4))}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    empty = spark.createDataFrame([], schema)
    assert blocked.compared_pairs(empty, spark.createDataFrame(b, schema), ["one", "two", "three"], jaro_winkler_of).count() == 0
