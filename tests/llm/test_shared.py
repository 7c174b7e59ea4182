import random

import pytest

from usagelens.llm.shared import components


def brute(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def random_links():
    rng = random.Random(9)
    return [(rng.randrange(300), rng.randrange(300)) for _ in range(160)]


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(120)],                          # a chain
    [(1000 - i, 1000 - i - 1) for i in range(60)] + [(5, 6)],  # a chain of falling ids
    [(7, i) for i in range(500) if i != 7],                    # a hub
    random_links(), [(2 ** 62, -5), (-5, 3), (4, 9), (9, 4)], [],
], ids=["chain", "falling", "hub", "random", "extremes", "none"])
def test_components(spark, edges):
    links = spark.createDataFrame(edges, "a long, b long").repartition(3)
    out = components(links).collect()
    want = {x: c for x, c in brute([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.component for r in out} == want and len(out) == len(want)
