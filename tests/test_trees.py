"""Walks over self-referencing keys, against chains, circles and keys without a node."""

import random

from haulmark.functions import scalars as S
from haulmark.operators.graphs import circles
from haulmark.operators.trees import walk_down
from haulmark.plans.telemetry import head_blockers


def test_a_chain_of_500_levels(spark):
    nodes = spark.createDataFrame([(k, k - 1 if k else None) for k in range(500)], "node long, parent long")
    got = {r.node: r for r in walk_down(nodes, "node", "parent").collect()}
    assert {k: (r.root, r.depth) for k, r in got.items()} == {k: (0, k) for k in range(500)}
    assert got[499].path == "/".join(map(str, range(500))) and got[0].path == "0"


def test_circles_and_missing_parents_are_not_reached(spark):
    up = {1: None, 2: 1, 3: 1, 4: 3, 10: 12, 11: 10, 12: 11, 13: 10, 14: 13, 20: 20, 30: 99, 31: 30}
    nodes = spark.createDataFrame(list(up.items()), "node long, parent long")
    got = {(r.node, r.root, r.parent, r.depth, r.path) for r in walk_down(nodes, "node", "parent").collect()}
    assert got == {(1, 1, None, 0, "1"), (2, 1, 1, 1, "1/2"), (3, 1, 1, 1, "1/3"), (4, 1, 3, 2, "1/3/4")}


def test_long_blocking_chain_has_one_head(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 151)] + [(900, 901), (901, 900)],
                                  "session_id long, blocking_session_id long")
    got = {r.session_id: r.head_session for r in head_blockers(edges).collect()}
    assert got == {k: 151 for k in range(1, 152)} | {900: 900, 901: 900}


def reached(edges):
    after = {}
    for u, v in edges:
        after.setdefault(u, set()).add(v)
    out = {}
    for start in after:
        seen, left = set(), list(after[start])
        while left:
            node = left.pop()
            if node not in seen:
                seen.add(node)
                left += after.get(node, ())
        out[start] = seen
    return out


def brute_circles(edges):
    reach = reached(edges)
    return {n: (min(c), len(c)) for n in reach if n in reach[n] for c in [[m for m in reach[n] if n in reach.get(m, ())]]}


def found_circles(spark, edges):
    rows = circles(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: (r.circle, r.members) for r in rows}


def test_a_circle_of_500_with_a_chain_before_and_behind(spark):
    edges = ([(k, k % 500 + 1) for k in range(1, 501)] + [(1000 + k, 1001 + k) for k in range(9)] + [(1009, 77)]
             + [(3, 2000), (2000, 2001), (2001, 2002)])
    assert found_circles(spark, edges) == {k: (1, 500) for k in range(1, 501)} == brute_circles(edges)


def test_circles_of_random_graphs(spark):
    rng = random.Random(2)
    for nodes, edges in ((60, 75), (25, 60)):
        graph = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)]
        assert found_circles(spark, graph + graph[:5]) == brute_circles(graph)


def test_loops_nulls_and_graphs_without_circles(spark):
    assert found_circles(spark, [(1, 1), (1, 2), (2, 1), (3, 3), (4, 5), (None, 4), (5, None)]) == {1: (1, 2), 2: (1, 2), 3: (3, 1)}
    assert found_circles(spark, [(1, 2), (2, 3)]) == {} and found_circles(spark, []) == {}


def test_a_circle_is_the_head_of_what_waits_for_it(spark):
    edges = [(k, k % 40 + 1) for k in range(1, 41)] + [(100, 7), (101, 100), (102, 101), (103, 100), (200, 201), (300, 300), (301, 300)]
    got = {r.session_id: (r.head_session, r.depth) for r in head_blockers(spark.createDataFrame(
        edges + [(500, 0)], "session_id long, blocking_session_id long")).collect()}
    assert got == ({k: (1, 0) for k in range(1, 41)} | {100: (1, 1), 101: (1, 2), 102: (1, 3), 103: (1, 2)}
                   | {200: (201, 1), 201: (201, 0), 300: (300, 0), 301: (300, 1)})


def test_numbers_longer_than_their_padding_stay_whole(spark):
    got = spark.createDataFrame([(7,), (99999,), (1234567,), (2234567,)], "k long")
    assert [r[0] for r in got.select(S.zero_pad_least(got.k, 5)).collect()] == ["00007", "99999", "1234567", "2234567"]
