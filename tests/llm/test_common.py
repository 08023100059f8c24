"""Connected components and small helpers."""

import random

import numpy as np

from tastespark.llm import common

EDGES = "a long, b long"


def plain(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {(x, find(x)) for x in parent}


def run(spark, make, edges):
    return {(r.node, r.component) for r in common.components(spark, make(edges, EDGES)).collect()}


def test_chain_star_and_random(spark, make):
    rnd = random.Random(1)
    order = list(range(200))
    rnd.shuffle(order)
    edges = list(zip(order, order[1:])) + [(1000, 1000 + i) for i in range(1, 60)] + [(3000 - i, 3000) for i in range(1, 60)]
    edges += [(5000 + rnd.randrange(150), 5000 + rnd.randrange(150)) for _ in range(110)] + [(-7, 9_000_000_000), (-7, -7), (1, 1)]
    assert run(spark, make, edges) == plain(edges)


def test_no_edges(spark, make):
    assert run(spark, make, []) == set() and run(spark, make, [(4, 4)]) == set()


def test_text_chunks_cover_every_text_once():
    texts = ["a" * 5, None, "", "b" * 100, "c", "d" * 7]
    cuts = list(common.text_chunks(texts, 8))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(texts) and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:]))
    assert list(common.text_chunks([])) == []


def test_mix_is_a_bijection_on_samples():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(common.mix64(x))) == len(x)
