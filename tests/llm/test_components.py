"""Components against union-find."""

import random

from casework.llm.common import star_rounds


def test_star_rounds(spark):
    rnd = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    rnd.shuffle(chain)
    edges = chain + [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(5000, k) for k in range(5001, 5300)] + [(7, 7), (-3, 2**40)]
    edges += [(b, a) for a, b in edges[:50]]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component_id"] for r in star_rounds(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {x: find(x) for x in touched}


def test_no_edges(spark):
    assert star_rounds(spark.createDataFrame([], "a long, b long"), "t").count() == 0
