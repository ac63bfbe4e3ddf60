import random

import numpy as np
import pytest

from stayline.llm.components import Forest, components


def roots(links):
    up = {}
    for a, b in links:
        up.setdefault(a, a)
        up.setdefault(b, b)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        ra, rb = find(a), find(b)
        up[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in up}


CASES = [
    [],
    [(2, 1)],
    [(i, i + 1) for i in range(70)],
    [(i, i + 1) for i in range(0, 70, 2)] + [(i, 100 - i) for i in range(30)],
    [(0, i) for i in range(1, 40)] + [(39, i) for i in range(40, 80)] + [(200, 201), (201, 202), (202, 200), (200, 201)],
    [(random.Random(1).randint(0, 90), random.Random(i).randint(0, 90)) for i in range(80)],
]


@pytest.mark.parametrize("links", CASES)
def test_components(spark, links):
    links = [x for x in links if x[0] != x[1]]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == roots(links)


@pytest.mark.parametrize("links", CASES[1:])
def test_forest(links):
    f = Forest(300)
    a, b = (np.array(x) for x in zip(*links))
    for i in range(0, len(a), 7):
        f.link(a[i:i + 7], b[i:i + 7])
    for x, r in roots([x for x in links if x[0] != x[1]]).items():
        assert f.up[x] == r
