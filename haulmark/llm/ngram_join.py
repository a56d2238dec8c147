"""N-gram Jaccard join by T-occurrence search over inverted lists (DivideSkip), and its components.

A text's set is its distinct shingles of ``width`` words. Texts with equal sets are one node. Two nodes whose
similarity reaches the threshold share at least t = ceil(threshold * n) shingles, so their prefixes of n - t + k
shingles, in any common order, share at least k. The order is rare first, by a counting sketch over all shingles,
and k = 1 + n // 50, the smaller of both nodes'. Lists hold prefixes only; lists of one node go, and nodes with fewer
lists than any pair of theirs would share.

1. Each node is compared with one node of another component: of the first nodes of its lists, each list in an order of
   its own, the one whose parities (below) are nearest. Turns, each with other orders, link nearly all of a large group of
   copies with one pair per node and turn; they go on while they link more than one of ``STOP`` nodes, at most
   ``LEADER_TURNS`` times. One more turn takes the nearest of all members that the exact search would meet, one of each
   other component: a node that links to a large group is linked by it, not by all its links to the group.
2. The exact search covers what is left: only lists that still hold nodes of different components, and only pairs of
   different components. Short lists, and all lists of a node whose prefix has so many long ones that k could be
   reached by these alone (a heavy node), come to the querying node and are heap-merged; the long lists of a pair that
   is not of two heavy nodes are probed by binary search in the candidate's own list numbers. A light node has fewer
   long lists than k, so such a pair meets in a short one. Candidates that reach k are compared.

A pair is first held against the parities of both sets: bits by hash, at least one per shingle. Where they differ, the
sets differ, so pairs with too many such bits go without a loss, in the exact search before its lists are merged; only the
others bring their sets together.
Every comparison is exact, on the whole sets. Lists and members are joined in chunks of bounded size.

Defined cases: null and wordless texts have no set and no links; a text of fewer than ``width`` words has its whole
sequence as its one shingle; repeated rows, also with one doc_id or none, are nodes like others. A component's id is
its smallest doc_id that is not null.
"""

from __future__ import annotations

import heapq
from functools import reduce
from itertools import groupby
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm import sketch, text
from haulmark.llm.common import Rounds, components, map_batches, record_batch, stage

LONG_LIST = 256
LEADER_TURNS = 12
STOP = 25
_LEAST_BITS = 256
_WORDS = _LEAST_BITS // 64
_ADD = np.uint64(0x9E3779B97F4A7C15)


def _sets(column: pa.Array, width: int):
    """(first row, hashes, bounds, owner) of runs of texts; the hashes of a text are distinct and sorted."""
    for row, _, data, offsets in text.pieces(column):
        hashes, bounds = text.shingles(text.words(data, offsets, text.NOT_BLANK), width)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        first = np.ones(len(hashes), dtype=bool)
        first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[first], owner[first]
        yield row, hashes, np.searchsorted(owner, np.arange(len(bounds))), owner


def _node(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit number per set."""
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(text.mix(hashes + _ADD), out=sums[1:])
    return text.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * _ADD).view(np.int64)


def _parities(hashes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """For each set the parity of its hashes by their low bits, in a power of two of bits not below its size."""
    n = np.diff(bounds)
    bits = np.where(n > 0, np.maximum(_LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)), 0)
    ends = np.concatenate([[0], np.cumsum(bits)])
    place = (hashes & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64) + np.repeat(ends[:-1], n)
    odd = (np.bincount(place, minlength=ends[-1]) & 1).astype(np.uint8)
    held = np.packbits(odd, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((ends // 8).astype(np.int32)), pa.py_buffer(held)])


def _short_parities(hashes: np.ndarray, owner: np.ndarray, sets: int) -> pa.Array:
    """The same folded to four words of 64 bits."""
    place = (hashes & np.uint64(_LEAST_BITS - 1)).astype(np.int64) + owner * _LEAST_BITS
    odd = (np.bincount(place, minlength=sets * _LEAST_BITS) & 1).astype(np.uint8)
    words = np.packbits(odd, bitorder="little").view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, _WORDS), pa.int32()), pa.array(words))


def _differing(x: bytes, y: bytes) -> int:
    """At least so many shingles are in one of the sets only. The longer row of parities is folded to the shorter's."""
    if len(x) > len(y):
        x, y = y, x
    mine, other, size = int.from_bytes(x, "little"), int.from_bytes(y, "little"), len(y) * 8
    while size > len(x) * 8:
        size //= 2
        other = (other >> size) ^ (other & ((1 << size) - 1))
    return (mine ^ other).bit_count()


def _needed(n, percent):
    return -(-percent * n // 100)


def _k(n):
    return 1 + n // 50


def signed_sets(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, node, the prefix (hashes, in rare-first order) and the parities of each row."""
    docs = documents.select("doc_id", "text")

    def all_hashes(batch):
        for _, hashes, _, _ in _sets(batch.column(0), width):
            yield hashes
    rarity = docs.sparkSession.sparkContext.broadcast(sketch.counts(docs.select("text"), all_hashes))

    def each(batch):
        size, node, prefix, parity, short = [], [], [], [], []
        for _, hashes, bounds, owner in _sets(batch.column(1), width):
            n = np.diff(bounds)
            order = np.lexsort((hashes, rarity.value[sketch.slots(hashes)], owner))
            place = np.arange(len(hashes)) - bounds[owner]
            kept = order[place < np.minimum(n, n - _needed(n, percent) + _k(n))[owner]]
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[kept], minlength=len(n)))])
            lists = hashes[kept].view(np.int64)
            size.append(n)
            node.append(_node(hashes, bounds))
            prefix.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(lists)))
            parity.append(_parities(hashes, bounds))
            short.append(_short_parities(hashes, owner, len(n)))
        yield record_batch(doc_id=batch.column(0), n=pa.array(np.concatenate(size or [np.zeros(0, np.int64)]), pa.int64()),
                           node=pa.array(np.concatenate(node or [np.zeros(0, np.int64)])),
                           prefix=pa.concat_arrays(prefix) if prefix else pa.array([], pa.list_(pa.int64())),
                           parity=pa.concat_arrays(parity) if parity else pa.array([], pa.binary()),
                           short=pa.concat_arrays(short) if short else pa.array([], pa.list_(pa.int64())))
    return map_batches(docs, "doc_id long, n long, node long, prefix array<long>, parity binary, short array<long>", each)


def _compatible(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _least_k(percent: int) -> Column:
    """A partner may be smaller, and then so is its k: the smallest k that a pair with this node can have."""
    return F.floor(F.floor(F.col("n") * percent / 100) / 50) + 1


def node_sets(documents: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """node and its set, as sorted hashes, of the given nodes. A sketch of them keeps most other texts out of the shuffle."""
    asked = documents.sparkSession.sparkContext.broadcast(
        sketch.counts(nodes, lambda batch: [text.mix(batch.column(0).to_numpy().view(np.uint64))]) > 0)

    def each(batch):
        for _, hashes, bounds, _ in _sets(batch.column(0), width):
            node = _node(hashes, bounds)
            kept = np.flatnonzero(asked.value[sketch.slots(text.mix(node.view(np.uint64)))] & (np.diff(bounds) > 0))
            kept = kept[np.unique(node[kept], return_index=True)[1]]
            yield record_batch(node=pa.array(node[kept]), held=pa.array([hashes[bounds[k]:bounds[k + 1]].tobytes() for k in kept], pa.binary()))
    found = map_batches(documents.select("text"), "node long, held binary", each)
    return found.join(nodes, "node").groupBy("node").agg(F.max("held").alias("held"))


def verified(pairs: DataFrame, parities: DataFrame, sets: DataFrame, percent: int, rounds: Rounds) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough."""
    def both(frame, table, column):
        for side in ("a", "b"):
            frame = frame.join(table.select(F.col("node").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in column)), side)
        return frame.select("a", "b", *(f"{c}_{side}" for c in column for side in ("a", "b")))

    def near(batch):
        rows = zip(*(batch.column(c).to_pylist() for c in range(2, 6)), strict=True)
        kept = [k for k, (n, m, x, y) in enumerate(rows) if (n + m - _differing(x, y)) * (100 + percent) >= 2 * percent * (n + m)]
        yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))
    likely = rounds.stage(map_batches(both(pairs.select("a", "b"), parities, ("n", "parity")), "a long, b long", near), "jaccard-likely")
    nodes = rounds.stage(likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct(), "jaccard-asked")
    asked = rounds.stage(sets.join(nodes, "node").select("node", "held"), "jaccard-asked-sets")

    def each(batch):
        kept = []
        for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                kept.append(k)
        yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))
    found = rounds.stage(map_batches(both(likely, asked, ("held",)), "a long, b long", each), "jaccard-links")
    rounds.drop(likely, nodes, asked)
    return found


def _labelled(shared: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return shared.select("list", "node", "n", F.col("node").alias("component"))
    return (shared.select("list", "node", "n").join(labels, "node", "left")
            .select("list", "node", "n", F.coalesce("component", "node").alias("component")))


def _mixed(shared: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Entries (list, node, n, component) of the lists that still hold different components."""
    rows = _labelled(shared, labels)
    mixed = (rows.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .filter("low <> high").select("list"))
    return rows.join(mixed, "list")


def _turn(shared: DataFrame, labels: DataFrame | None, turn: int, percent: int) -> DataFrame:
    """Entries of the lists that still hold different components, each with the list's first node by this turn's order
    where that may be a partner. The order is another one in each list, so a node meets nearly as many others as it has lists."""
    rows = _labelled(shared, labels)
    first = F.min(F.struct(F.xxhash64("node", "list", F.lit(turn)).alias("order"), "node", "n", "component")).alias("leader")
    leaders = (rows.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"), first)
               .filter("low <> high").select("list", "leader"))
    other = (F.col("component") != F.col("leader.component")) & _compatible(F.col("n"), F.col("leader.n"), percent)
    return rows.join(leaders, "list").select("list", "node", "n", F.when(other, F.col("leader.node")).alias("partner"))


def _leader_pairs(rows: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """Each node with the partner whose parities (folded) differ least from its own, where these allow a link."""
    def side(name):
        return parities.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("short").alias(f"short_{name}"))
    met = rows.filter("partner IS NOT NULL").groupBy("node", "partner").agg(F.count(F.lit(1)).alias("times"))
    words = [[F.col(f"short_{name}")[k] for k in range(_WORDS)] for name in ("node", "partner")]
    differ = _folded_differing(*words)
    return (met.join(side("node"), "node").join(side("partner"), "partner")
            .filter(_may_link(F.col("n_node"), F.col("n_partner"), *words, percent))
            .groupBy("node").agg(F.min_by("partner", F.struct(differ, -F.col("times"), "partner")).alias("b"))
            .select(F.col("node").alias("a"), "b"))


def _merge(batch: pa.RecordBatch):
    """Heap-merge of a node's lists: the candidates that are in enough of them, and in how many."""
    query, candidate, times = [], [], []
    for node, lists, least in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        for other, run in groupby(heapq.merge(*lists)):
            found = sum(1 for _ in run)
            if found >= least:
                query.append(node)
                candidate.append(other)
                times.append(found)
    yield record_batch(a=pa.array(query, pa.int64()), b=pa.array(candidate, pa.int64()), times=pa.array(times, pa.int64()))


def _probe(batch: pa.RecordBatch):
    """Adds the long lists that both are in, found by binary search, and keeps who reaches the number needed."""
    kept = []
    for k, (times, least, mine, theirs) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 6)), strict=True)):
        if times < least and mine and theirs:
            theirs = np.array(theirs)
            at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
            times += int((theirs[at] == np.array(mine)).sum())
        if times >= least:
            kept.append(k)
    yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))


def _folded_differing(mine, other) -> Column:
    """At least so many shingles are in one of the sets only, by their folded parities."""
    return reduce(add, (F.bit_count(x.bitwiseXOR(y)) for x, y in zip(mine, other, strict=True)))


def _may_link(n: Column, m: Column, mine, other, percent: int) -> Column:
    """Whether two sets whose parities (folded) these are can be similar enough."""
    return (n + m - _folded_differing(mine, other)) * (100 + percent) >= (n + m) * (2 * percent)


def _met(rows: DataFrame, lists: DataFrame, percent: int, parities: DataFrame | None, rounds: Rounds | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged entries, nodes with long lists, each merged entry with those members of its list that may link to it).

    Members whose folded ``parities`` rule a link out are not merged, so what the merge reads in a large group of
    texts that are alike, but not enough, is near what it keeps.
    """
    stage = (rounds or Rounds(rows.sparkSession)).stage
    words = [f"word_{k}" for k in range(_WORDS)]
    if parities is None:
        rows = rows.select("*", *(F.lit(0).cast("long").alias(w) for w in words))
    else:
        rows = rows.join(parities.select("node", *(F.col("short")[k].alias(w) for k, w in enumerate(words))), "node")
    rows = stage(rows.join(lists, "list").withColumn("long", F.col("size") > LONG_LIST), "jaccard-entries")
    least_k = _least_k(percent)
    heavy = (rows.filter("long").groupBy("node").agg(F.max(least_k).alias("least"), F.array_sort(F.collect_set("list")).alias("longs"))
             .withColumn("heavy", F.size("longs") >= F.col("least")))
    heavy = stage(heavy.select("node", "longs", "heavy"), "jaccard-long")
    merged = (rows.join(heavy.select("node", "heavy", F.size("longs").alias("n_longs")), "node", "left")
              .withColumn("heavy", F.coalesce("heavy", F.lit(False))).filter("NOT long OR heavy"))
    # ``unseen``: how many lists of the node are not merged.
    unseen = F.when(F.col("heavy"), 0).otherwise(F.coalesce("n_longs", F.lit(0))).alias("unseen")
    merged = stage(merged.select("list", "node", "n", "component", "size", "heavy", unseen, *words), "jaccard-merged")
    chunks = F.greatest(F.lit(1), F.ceil(F.col("size") / LONG_LIST))
    members = (merged.groupBy("list", F.pmod(F.xxhash64("node"), chunks).alias("chunk"))
               .agg(F.array_sort(F.collect_list(F.struct("node", "n", "component", "unseen", *words))).alias("members")))
    members = stage(members.select("list", "members"), "jaccard-chunks")
    asked = merged.join(members, "list").withColumn("members", F.filter("members", lambda m: (
        (m["node"] < F.col("node")) & (m["component"] != F.col("component")) & _compatible(m["n"], F.col("n"), percent)
        & _may_link(m["n"], F.col("n"), [m[w] for w in words], [F.col(w) for w in words], percent))))
    return merged, heavy, asked


def _closest(asked: DataFrame) -> DataFrame:
    """Pairs of each node with one node of each other component that it meets: of each list's members the one whose
    parities (folded) differ least, and of these again the one. They are no more than the entries of the lists."""
    words = [f"word_{k}" for k in range(_WORDS)]
    best = F.array_min(F.transform("members", lambda m: F.struct(
        _folded_differing([m[w] for w in words], [F.col(w) for w in words]).alias("differ"), m["node"].alias("node"), m["component"].alias("component"))))
    return (asked.select("node", best.alias("best")).filter("best IS NOT NULL")
            .groupBy(F.col("node").alias("a"), "best.component").agg(F.min("best").alias("best")).select("a", F.col("best.node").alias("b")))


def _rest(rows: DataFrame, lists: DataFrame, percent: int, parities: DataFrame | None = None, rounds: Rounds | None = None) -> DataFrame:
    """Candidate pairs between the components so far, which read tables that ``rounds`` has stored."""
    merged, heavy, asked = _met(rows, lists, percent, parities, rounds)
    least_k = _least_k(percent)
    # Lists that a pair shares and that are not merged are at most those of the light node; partners with such lists are
    # merged apart, so that a heavy node asks for fewer merged lists of these only. One is needed of every pair.
    apart = F.explode(F.array(F.struct(F.lit(False).alias("some"), F.filter("members", lambda m: m["unseen"] == 0).alias("members")),
                              F.struct(F.lit(True).alias("some"), F.filter("members", lambda m: m["unseen"] > 0).alias("members")))).alias("part")
    lists_of = (asked.select("node", "n", "heavy", "unseen", apart).filter(F.size("part.members") > 0)
                .select("node", "part.some", F.col("part.members.node").alias("others"), least_k.alias("least"),
                        F.when(F.col("heavy"), F.array_max("part.members.unseen")).otherwise(F.col("unseen")).alias("unseen"))
                .groupBy("node", "some").agg(F.collect_list("others").alias("lists"), F.max("least").alias("least"), F.max("unseen").alias("unseen"))
                .select("node", "lists", F.greatest(F.col("least") - F.col("unseen"), F.lit(1)).alias("least")))
    found = map_batches(lists_of, "a long, b long, times long", _merge)
    sizes = merged.select("node", "n").distinct()
    for side in ("a", "b"):
        found = (found.join(sizes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
                 .join(heavy.select(F.col("node").alias(side), F.col("longs").alias(f"longs_{side}"), F.col("heavy").alias(f"heavy_{side}")),
                       side, "left"))
    least = F.floor(F.least("n_a", "n_b") / 50) + 1
    # The merge has counted the long lists of two heavy nodes, and of no other pair.
    probed = F.when(F.coalesce(F.col("heavy_a") & F.col("heavy_b"), F.lit(False)), None).otherwise(F.col("longs_a")).alias("longs_a")
    return map_batches(found.select("a", "b", "times", least.alias("least"), probed, "longs_b"), "a long, b long", _probe)


def join(documents: DataFrame, width: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """(rows with doc_id, n and node; node and component of nodes with links). A link: percent or more similar."""
    rounds = Rounds(documents.sparkSession)
    signed = rounds.stage(signed_sets(documents, width, percent), "jaccard-sets")
    placed = rounds.stage(signed.select("doc_id", "n", "node"), "jaccard-rows")
    nodes = rounds.stage(signed.filter("n > 0").groupBy("node").agg(F.any_value(F.struct("n", "prefix", "parity", "short")).alias("held"))
                         .select("node", "held.n", "held.prefix", "held.parity", "held.short"), "jaccard-nodes")
    rounds.drop(signed)
    entries = nodes.select("node", "n", F.explode("prefix").alias("list"))
    repeated = rounds.stage(entries.groupBy("list").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "jaccard-repeated")
    every = rounds.stage(entries.join(repeated, "list").select("list", "node", "n"), "jaccard-every")
    enough = every.groupBy("node", "n").agg(F.count(F.lit(1)).alias("lists")).filter(F.col("lists") >= _least_k(percent))
    asked = rounds.stage(enough.select("node"), "jaccard-nodes-asked")
    shared = rounds.stage(every.join(asked, "node").select("list", "node", "n"), "jaccard-shared")
    parities = rounds.stage(nodes.join(asked, "node").select("node", "n", "parity", "short"), "jaccard-parities")
    rounds.drop(nodes, every)
    sets = rounds.stage(node_sets(documents, asked, width), "jaccard-node-sets")
    rounds.drop(asked)

    links, labels, compared = None, None, parities.count()
    for turn in range(LEADER_TURNS):
        mixed = rounds.stage(_turn(shared, labels, turn, percent), "jaccard-turn")
        rounds.drop(shared)
        shared = mixed
        pairs = rounds.stage(_leader_pairs(mixed, parities, percent), "jaccard-leaders")
        found = verified(pairs, parities, sets, percent, rounds)
        done = found.count() * STOP <= compared
        links, labels = _linked(links, found, rounds)
        rounds.drop(pairs)
        if done:
            break
    searched = Rounds(documents.sparkSession)
    for last in (False, True):
        mixed = rounds.stage(_mixed(shared, labels), "jaccard-mixed")
        rounds.drop(shared)
        shared = mixed
        met = (mixed, repeated, percent, parities, searched)
        pairs = rounds.stage(_rest(*met) if last else _closest(_met(*met)[2]), "jaccard-pairs")
        searched.drop_all()
        links, labels = _linked(links, verified(pairs, parities, sets, percent, rounds), rounds)
        rounds.drop(pairs)
    rounds.drop(shared, repeated, parities, sets, links)
    return placed, labels


def _linked(links: DataFrame | None, found: DataFrame, rounds: Rounds) -> tuple[DataFrame, DataFrame]:
    """All links so far and their components."""
    after = found
    if links is not None:
        after = rounds.stage(links.union(found), "jaccard-all")
        rounds.drop(links, found)
    return after, components(after, "a", "b")


def report(documents: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: size of its set and the smallest doc_id that links reach."""
    rows, labels = join(documents, width, percent)
    placed = stage(rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "jaccard-placed")
    smallest = placed.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = placed.filter("n > 0").join(smallest, "component").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.union(placed.filter("n = 0").select("doc_id", "n", F.col("doc_id")))
