"""Circles in directed graphs of any size: strongly connected components by forward and backward colouring.

Every node starts with its own colour, a hash and its number, and takes the greatest colour of the nodes it reaches. The
nodes that the root of a colour reaches within the colour are one component with it, for they reach it too. They
leave, and the rest is searched again. In both searches a round follows all edges by one step and, for each node, one path
by a pointer to a successor that doubles its length every round. Where nodes have one successor, as sessions that wait
for one other, n nodes take log n rounds, however long a circle or a chain is; with many successors the pointers
choose again from time to time, and the bound is the length of the shortest paths. All steps are joins and maxima with partial aggregates; the driver sees one flag per round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.session import new_path
from haulmark.sources.writes import discard

_c = F.col


class _Rounds:
    """A stored frame that is replaced round by round; the files of a round go when its successor is stored."""

    def __init__(self, label: str):
        self.label, self.path, self.frame = label, None, None

    def store(self, df: DataFrame) -> DataFrame:
        path = new_path(df.sparkSession, self.label)
        df.write.parquet(path)
        before, self.path = self.path, path
        self.frame = df.sparkSession.read.schema(df.schema).parquet(path)
        if before:
            discard(df.sparkSession, before)
        return self.frame


def _successors(edges: DataFrame, turn: int = 0) -> DataFrame:
    """(node, ahead): one successor of each node, another choice each turn; a node without one points at itself."""
    nodes = edges.select(_c("u").alias("node")).union(edges.select("v")).distinct()
    one = edges.groupBy(_c("u").alias("node")).agg(F.max_by("v", F.xxhash64("u", "v", F.lit(turn))).alias("ahead"))
    return nodes.join(one, "node", "left").select("node", F.coalesce("ahead", "node").alias("ahead"))


def _turns():
    """False for the rounds of a turn and True for its last one: 10 rounds, then 20, 40 and so on.

    A path that a pointer follows may end off the circle that its node lies on; the next turn takes another path.
    """
    length = 10
    while True:
        yield from [False] * (length - 1)
        yield True
        length *= 2


def _greatest_reached(edges: DataFrame, rounds: _Rounds) -> DataFrame:
    """(node, colour): the greatest colour among the nodes that a node of ``edges`` (u, v) reaches, itself included."""
    state = rounds.store(_successors(edges).select(
        "node", F.struct(F.xxhash64("node").alias("h"), _c("node").alias("root")).alias("colour"), "ahead", F.lit(True).alias("moved")))
    turns, turn = _turns(), 0
    while state.filter("moved").limit(1).count():
        seen = state.select(_c("node").alias("v"), _c("colour").alias("other"))
        over = edges.join(seen, "v").groupBy(_c("u").alias("node")).agg(F.max("other").alias("other"))
        far = state.select(_c("node").alias("ahead"), _c("colour").alias("above"), _c("ahead").alias("further"))
        now = F.greatest("colour", "other", "above")
        state = rounds.store(state.join(over, "node", "left").join(far, "ahead").select(
            "node", now.alias("colour"), _c("further").alias("ahead"), (now > _c("colour")).alias("moved")))
        if next(turns):
            turn += 1
            state = rounds.store(state.drop("ahead").join(_successors(edges, turn), "node"))
    return state.select("node", "colour")


def _reached(edges: DataFrame, roots: DataFrame, rounds: _Rounds) -> DataFrame:
    """(node): all nodes of ``edges`` that some node of ``roots`` reaches, the roots included."""
    first = roots.select("node", F.lit(True).alias("root"))
    state = rounds.store(_successors(edges).join(first, "node", "left").select(
        "node", "ahead", _c("root").isNotNull().alias("reached"), F.lit(True).alias("moved")))
    turns, turn = _turns(), 0
    while state.filter("moved").limit(1).count():
        hot = state.filter("reached")
        pushed = (hot.select(_c("ahead").alias("node")).union(edges.join(hot, edges["u"] == hot["node"]).select("v"))
                  .distinct().withColumn("pushed", F.lit(True)))
        far = state.select(_c("node").alias("ahead"), _c("ahead").alias("further"))
        now = _c("reached") | _c("pushed").isNotNull()
        state = rounds.store(state.join(pushed, "node", "left").join(far, "ahead").select(
            "node", _c("further").alias("ahead"), now.alias("reached"), (now & ~_c("reached")).alias("moved")))
        if next(turns):
            turn += 1
            state = rounds.store(state.drop("ahead").join(_successors(edges, turn), "node"))
    return state.filter("reached").select("node")


def circles(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node, circle, members) of all nodes on a circle: the least node of the component names it.

    An edge from a node to itself is a circle of one. Edges with a null end and repeated edges do not matter.
    """
    work_rounds, forward, backward = _Rounds("circle-edges"), _Rounds("circle-forward"), _Rounds("circle-backward")
    known = _Rounds("circle-graph").store(edges.select(_c(source).alias("u"), _c(target).alias("v"))
                                          .filter("u IS NOT NULL AND v IS NOT NULL").distinct())
    loops = known.filter("u = v").select(_c("u").alias("node"), _c("u").alias("circle"), F.lit(1).cast("long").alias("members"))
    work = work_rounds.store(_both_ways(known.filter("u <> v")))
    found = []
    while work.limit(1).count():
        colours = _greatest_reached(work, forward)
        of_u, of_v = (colours.select(_c("node").alias(end), _c("colour").alias(f"{end}_colour")) for end in "uv")
        inner = _Rounds("circle-inner").store(work.join(of_u, "u").join(of_v, "v").filter("u_colour = v_colour").select("u", "v"))
        back = _reached(inner, colours.filter("node = colour.root").select("node"), backward)
        closed = _Rounds("circle-found").store(colours.join(back, "node"))
        found.append(closed)
        # Edges to other colours lie on no circle; a root that nothing reaches back is left without edges.
        gone = closed.select("node")
        work = work_rounds.store(_both_ways(inner.join(gone, inner["u"] == gone["node"], "left_anti")
                                            .join(gone, inner["v"] == gone["node"], "left_anti")))
    if not found:
        return loops
    parts = reduce(DataFrame.unionAll, found)
    sizes = parts.groupBy("colour").agg(F.min("node").alias("circle"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    long = parts.join(sizes, "colour").select("node", "circle", "members")
    return long.unionAll(loops.join(long.select("node"), "node", "left_anti"))


def _both_ways(edges: DataFrame) -> DataFrame:
    """Edges that can lie on a circle at first sight: something leads to their start, and their end leads on."""
    starts, ends = edges.select(_c("u").alias("v")).distinct(), edges.select(_c("v").alias("u")).distinct()
    return edges.join(starts, "v", "left_semi").join(ends, "u", "left_semi")
