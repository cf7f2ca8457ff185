"""Connected components against a plain union of sets."""

import numpy as np

from costflow.llm.components import components


def plain_roots(edges):
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {a: find(a) for a in parent}


def test_chains_hubs_loops_and_repeats(spark):
    rng = np.random.default_rng(12)
    chain = [(i, i + 1) for i in range(1000, 1300)]
    ids = (rng.permutation(200) - 100).tolist()
    shuffled = list(zip(ids, ids[1:]))
    hub = [(5000, 5001 + i) for i in range(300)]
    random = [tuple(map(int, rng.integers(7000, 7400, 2))) for _ in range(250)]
    edges = [*chain, *shuffled, *hub, *random, (9, 9), (1000, 1001), (1001, 1000), (2**62, -(2**62))]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == plain_roots(edges)


def test_nothing_to_connect(spark):
    for edges in ([], [(1, 1), (2, 2)]):
        assert components(spark.createDataFrame(edges, "a long, b long")).collect() == []
