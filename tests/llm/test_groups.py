import random

import pytest

from venueweave.llm import groups
from venueweave.operators.components import both_ways
from venueweave.storage import Stash

EDGES = "left bigint, right bigint, id bigint, group_id string"


def naive(edges):
    group = {}
    for a, b in edges:
        for x in (a, b):
            group.setdefault(x, {x})
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    return {x: min(g) for x, g in group.items()}


# peeled for one round, as long as it pays, to the end
@pytest.mark.parametrize(("kind", "when"), [*((k, w) for k in ("star and chain", "giant", "sorted chain") for w in ((float("inf"), 2.0), (1.5, 0.125))), ("giant", (0.0, 0.0))])
def test_as_union_find(spark, monkeypatch, kind, when):
    monkeypatch.setattr(groups, "GROWTH", when[0])
    monkeypatch.setattr(groups, "PAYING_SHARE", when[1])
    rng = random.Random(6)
    edges = {
        "star and chain": [(5, i) for i in range(10, 60)] + [(i, i + 1) for i in range(100, 160)] + [(59, 100)],
        "giant": [(rng.randrange(200), rng.randrange(200)) for _ in range(260)] + [(900, 901)],
        "sorted chain": [(i + 1, i) for i in range(80)] + [(500, 501), (501, 502)],
    }[kind]
    data = [(a, b, 1, "x") for a, b in [*edges, *edges[:3]]] + [(None, 1, 1, "x"), (7, 7, 1, "x")]
    found = dict(tuple(r) for r in groups.consolidate(spark.createDataFrame(data, EDGES), "left", "right").collect())
    assert found == naive([e for e in edges if e[0] != e[1]])


def test_valid_ends_and_empty(spark):
    frame = spark.createDataFrame([(1, 2, 1, ""), (2, 3, 1, ""), (3, 4, 1, "")], EDGES)
    valid = spark.createDataFrame([(1,), (2,), (4,), (2,), (None,)], "raw_id bigint")
    assert dict(tuple(r) for r in groups.consolidate(frame, "left", "right", valid).collect()) == {1: 1, 2: 1}
    assert groups.consolidate(frame.limit(0), "left", "right").count() == 0


def test_peels_behind_a_hub_of_a_tiny_share(spark):
    """A tree of 1,093 vertices beside 50,000 pairs: its hub has one vertex in 25,000 as neighbours, and all of it is peeled."""
    tree = [(i, 3 * i + k) for i in range(1, 365) for k in (-1, 0, 1)]
    pairs = spark.range(50_000).selectExpr("10000 + 2 * id as a", "10001 + 2 * id as b")
    edges = spark.createDataFrame(tree, "a bigint, b bigint").unionByName(pairs)
    reached, rest, _ = groups.peel(Stash(both_ways(edges), "arcs"), 1, "bigint")
    assert reached.count() == 1093 and rest.count() == 100_000


def test_minimum_of_unlucky_chains(spark):
    chain = [(i, i + 1) for i in range(300)]
    comb = [(1000 + 2 * i, 1001 + 2 * i) for i in range(60)] + [(1001 + 2 * i, 1002 + 2 * i) for i in range(60)]
    edges = spark.createDataFrame([*chain, *comb], "a bigint, b bigint")
    assert dict(tuple(r) for r in groups.propagate_minimum(edges).collect()) == naive([*chain, *comb])
