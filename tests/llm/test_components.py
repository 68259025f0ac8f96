"""Connected components of link tables, against a walk in plain Python."""

import random

from corvid.llm.common import Stash
from corvid.llm.exchange import components


def walked(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    root = {}
    for n in sorted(near):
        todo = [] if n in root else [n]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = n
                todo += near[x]
    return root


def found(spark, edges):
    rows = components(Stash(spark, "components"), spark.createDataFrame(edges, "a long, b long"), "t").collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.root for r in rows}


def test_shuffled_chain_is_one_component(spark):
    ids = list(range(1000))
    random.Random(1).shuffle(ids)
    assert set(found(spark, list(zip(ids, ids[1:]))).items()) == {(n, 0) for n in ids}


def test_stars_trees_and_loops(spark):
    r = random.Random(2)
    edges = [(900, n) for n in range(100, 160)] + [(200, n) for n in range(201, 260)] + [(n, n + 1) for n in range(300, 320)]
    edges += [(r.randrange(400, 500), r.randrange(400, 500)) for _ in range(70)] + [(600, 600), (700, 701), (701, 700), (700, 701), (3, 1), (3, 2)]
    assert found(spark, edges) == walked(edges)


def test_no_links(spark):
    assert found(spark, []) == {}
