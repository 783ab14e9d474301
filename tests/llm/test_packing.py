import itertools
import random

import numpy as np

from cadastra.llm.packing import best_fit_decreasing, lower_bound, packed


def optimum(sizes, capacity):
    for n in itertools.count(1):
        def place(i, rooms):
            if i == len(sizes):
                return True
            seen = set()
            for j, r in enumerate(rooms):
                if r >= sizes[i] and r not in seen:
                    seen.add(r)
                    if place(i + 1, rooms[:j] + [r - sizes[i]] + rooms[j + 1:]):
                        return True
            return False

        if place(0, [capacity] * n):
            return n


def test_bounds_and_packing_against_the_optimum():
    rng = random.Random(5)
    for _ in range(60):
        cap = rng.choice([10, 17, 30])
        sizes = sorted((rng.randint(1, cap) for _ in range(rng.randint(1, 9))), reverse=True)
        s = np.array(sizes)
        bins = best_fit_decreasing(s, cap)
        best = optimum(sizes, cap)
        assert np.bincount(bins, weights=s).max() <= cap
        assert lower_bound(s, cap) <= best <= bins.max() + 1 <= best + 2


def run(spark, sizes, spec, **kw):
    s = spark.createDataFrame(sizes, "doc_id long, n_tokens int")
    return packed(s, spark.createDataFrame(spec, "container_kind string, capacity_tokens int"), **kw).collect()


def test_every_token_stands_once_and_no_container_overflows(spark):
    rng = random.Random(3)
    sizes = [(i, rng.choice([0, 1, 5, 30, 64, 100, 128, 129, 700])) for i in range(900)] + [(9999, None)]
    rows = run(spark, sizes, [("s", 128), ("l", 512), ("bad", 0), (None, 5), ("l", 300)], partition_items=200)
    for kind, cap in (("s", 128), ("l", 512)):
        mine = [r for r in rows if r.container_kind == kind]
        fill, seen = {}, {}
        for r in mine:
            fill[r.container_id] = fill.get(r.container_id, 0) + r.n_tokens
            seen.setdefault(r.doc_id, []).append((r.token_start, r.n_tokens))
        assert max(fill.values()) <= cap and seen.keys() == {d for d, _ in sizes}
        for d, n in sizes:
            n, at = n or 0, 0
            for start, length in sorted(seen[d]):
                assert start == at
                at += length
            assert at == n and (len(seen[d]) == 1 or n > cap)
        total = sum(n or 0 for _, n in sizes)
        assert len(fill) <= -(-total // cap) * 1.05 + 5
    assert {r.container_kind for r in rows} == {"s", "l"}


def test_empty_input(spark):
    assert run(spark, [], [("s", 10)]) == [] and run(spark, [(1, 3)], []) == []
