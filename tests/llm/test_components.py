import random

from cadastra.llm.components import connected_groups


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {v: find(v) for v in list(root)}


def run(spark, links, **kw):
    return {r.vertex: r.group for r in connected_groups(spark.createDataFrame(links, "a string, b string"), **kw).collect()}


def test_chains_hubs_and_random_graphs(spark):
    rng = random.Random(2)
    links = [(f"c{i:03}", f"c{i + 1:03}") for i in range(120)] + [("hub", f"h{i}") for i in range(300)]
    links += [(f"r{rng.randrange(400):03}", f"r{rng.randrange(400):03}") for _ in range(260)]
    assert run(spark, links) == brute(links)
    assert run(spark, links[:40], rate=2.0, hops=1) == brute(links[:40])


def test_self_null_and_repeated_links(spark):
    got = run(spark, [("a", "a"), ("b", "c"), ("c", "b"), ("b", "c"), (None, "d"), ("e", None)])
    assert got == {"a": "a", "b": "b", "c": "b"}


def test_no_links(spark):
    assert run(spark, []) == {}
