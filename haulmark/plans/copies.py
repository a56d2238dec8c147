"""Copies verified by hash trees: the root says whether two tables are equal, the way down says where they differ.

A leaf covers ``LEAF_KEYS`` consecutive values of a table's first key column and holds the number of its rows and an
order-free hash of them; a node above covers ``FANOUT`` nodes and hashes the places and contents of its leaves. All tables share
one stored tree, made by one scan of each, with a folder per level. Two trees are compared from the top: a level's nodes are read only
below nodes that differ, so the work follows the differences, not the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.plans.quality import RULES
from haulmark.session import new_path
from haulmark.sources.writes import stage

_LEAF_BITS, _FAN_BITS = 12, 8
LEAF_KEYS, FANOUT = 1 << _LEAF_BITS, 1 << _FAN_BITS
TOP = -(-(64 - _LEAF_BITS) // _FAN_BITS)  # the level where a table has one node, and one more if rows have no key
_SIGN = -(1 << 63)
_PIECE = 21  # bits: a hash is summed in three pieces as longs, which hold the sums of 2^42 rows
_MARKS = 62     # columns of one mark
_TOGETHER = 4
_c = F.col


def side_by_side(work: Callable[[str], DataFrame], names: Iterable[str]) -> dict[str, DataFrame]:
    """``work`` for some tables at a time, so that the small ones and the last tasks of the large ones leave no core idle."""
    names = list(names)
    with ThreadPoolExecutor(_TOGETHER) as pool:
        return dict(zip(names, pool.map(work, names), strict=True))


def _hashes(*parts) -> list:
    return [F.xxhash64(*parts).alias("__first"), F.xxhash64(F.lit("second"), *parts).alias("__second")]


def _content() -> list:
    """Order-free hash of rows with ``_hashes``; the sums cannot overflow, and two hashes have to agree."""
    low = (1 << _PIECE) - 1
    pieces = [F.shiftright("__first", k * _PIECE) if k == 2 else F.shiftright("__first", k * _PIECE).bitwiseAND(F.lit(low)) for k in range(3)]
    whole = [F.sum(piece).cast("decimal(20,0)") * F.lit(1 << k * _PIECE).cast("decimal(14,0)") for k, piece in enumerate(pieces)]
    return [(whole[0] + whole[1] + whole[2]).cast("decimal(38,0)").alias("content"), F.bit_xor("__second").alias("mixed")]


def _node_at(levels):
    """The node so many levels above a node."""
    return F.when(_c("node") < 0, -1).otherwise(F.call_function("shiftright", _c("node"), (levels * _FAN_BITS).cast("int")))


def _leaves(name: str, df: DataFrame) -> DataFrame:
    """Marks tell which values are null, so a value that moved to another column shows. Rows without key are node -1."""
    key = _c(RULES[name].keys[0][0]).cast("long")
    # With the sign bit turned the order of the keys is that of the unsigned numbers.
    node = F.coalesce(F.shiftrightunsigned(key.bitwiseXOR(F.lit(_SIGN)), _LEAF_BITS), F.lit(-1))
    columns = sorted(df.columns)
    marks = [reduce(add, (F.shiftleft(_c(c).isNull().cast("long"), k) for k, c in enumerate(columns[at:at + _MARKS]))) for at in range(0, len(columns), _MARKS)]
    parts = [*(_c(c) for c in columns), *marks]
    return (df.select(node.alias("node"), *_hashes(*parts)).groupBy("node").agg(F.count(F.lit(1)).alias("n_rows"), *_content())
            .select(F.lit(name).alias("table_name"), "node", "n_rows", "content", "mixed"))


class HashTree:
    """The stored tree of some tables: ``path/level=k`` holds table_name, node, n_rows, content, mixed. Level 0 are the leaves.

    A node's content is made from the leaves below it, so all levels come from one pass over the leaves.
    """

    def __init__(self, tables: Mapping[str, DataFrame], names: list[str] | None = None):
        names = list(tables) if names is None else names
        self.spark = tables[names[0]].sparkSession
        self.path = new_path(self.spark, "hash-tree")
        folder = new_path(self.spark, "hash-leaves")
        # Each by itself: a plan over all tables would be analysed anew with every table that joins it.
        parts = {name: _leaves(name, tables[name]) for name in names}
        side_by_side(lambda name: parts[name].write.parquet(f"{folder}/{name}"), names)
        self.schema = parts[names[0]].schema
        leaves = self.spark.read.schema(self.schema).parquet(f"{folder}/*")
        above = leaves.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(TOP))))
        above = above.select("level", "table_name", "n_rows", _node_at(_c("level")).alias("up"), *_hashes("node", "n_rows", "content", "mixed"))
        folded = above.groupBy("level", "table_name", "up").agg(F.sum("n_rows").alias("rows"), *_content())
        (folded.select("level", "table_name", _c("up").alias("node"), _c("rows").alias("n_rows"), "content", "mixed")
         .unionByName(leaves.withColumn("level", F.lit(0))).hint("rebalance", "level").write.partitionBy("level").parquet(self.path))

    def level(self, level: int) -> DataFrame:
        path = f"{self.path}/level={level}"
        return self.spark.read.schema(self.schema).parquet(path)


def _unequal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes that are not the same on both sides; a node that one side lacks has no rows there."""
    left = a.select("table_name", "node", _c("n_rows").alias("rows_a"), F.struct("n_rows", "content", "mixed").alias("a"))
    right = b.select("table_name", "node", _c("n_rows").alias("rows_b"), F.struct("n_rows", "content", "mixed").alias("b"))
    return (left.join(right, ["table_name", "node"], "full_outer").filter(~_c("a").eqNullSafe(_c("b")))
            .select("table_name", "node", F.coalesce("rows_a", F.lit(0)).alias("rows_a"), F.coalesce("rows_b", F.lit(0)).alias("rows_b")))


def differing(a: HashTree, b: HashTree) -> DataFrame:
    """table_name, low, high, rows_a, rows_b of every key range whose rows differ; rows without key have no range."""
    found = stage(_unequal(a.level(TOP), b.level(TOP)), "differing")
    steps = range(TOP - 1, -1, -1) if found.limit(1).count() else ()
    for at in steps:
        parents = found.select("table_name", _c("node").alias("up"))

        def below(tree: HashTree) -> DataFrame:
            return tree.level(at).withColumn("up", _node_at(F.lit(1))).join(parents, ["table_name", "up"], "left_semi")
        found = stage(_unequal(below(a), below(b)), "differing")
    low = F.when(_c("node") >= 0, F.shiftleft("node", _LEAF_BITS).bitwiseXOR(F.lit(_SIGN)))
    return found.select("table_name", low.alias("low"), (low + (LEAF_KEYS - 1)).alias("high"), "rows_a", "rows_b")


def verdicts(a: HashTree, b: HashTree) -> DataFrame:
    """table_name, rows_a, rows_b, same and the number of differing ranges for every table, from the tops and the ranges."""
    def rows(tree, name):
        return tree.level(TOP).groupBy("table_name").agg(F.sum("n_rows").alias(name))
    ranges = differing(a, b).groupBy("table_name").agg(F.count(F.lit(1)).alias("ranges"))
    both = rows(a, "rows_a").join(rows(b, "rows_b"), "table_name", "full_outer").join(ranges, "table_name", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows_a", "rows_b", "ranges")]
    return both.select("table_name", *zero, _c("ranges").isNull().alias("same"))
