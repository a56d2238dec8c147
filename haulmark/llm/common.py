"""Helpers that several operators share: column reads, Arrow batches, connected components."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.session import new_path, ship_package
from haulmark.sources.writes import discard, stage

__all__ = ["Rounds", "components", "cut", "map_batches", "once", "packed", "read", "record_batch", "running", "stage", "unpacked", "widened"]

#: Lengths of the parts that arrays and texts are worked on in, so that no step copies or scans a whole one.
_BLOCK, _CHARS = 64, 1024


class Rounds:
    """Stored tables of a job with many rounds, each removed as soon as no later step reads it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path = new_path(self.spark, label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Remove tables that this object stored; what reads them must be stored itself by now."""
        for table in tables:
            if table is not None and id(table) in self.paths:
                discard(self.spark, self.paths.pop(id(table))[1])

    def release(self) -> None:
        """Let Spark remove the shuffle files of steps that are done; it does so when the driver collects its garbage."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop_all(self) -> None:
        self.drop(*(table for table, _ in list(self.paths.values())))


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of an input table; any further column stays unread."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and, in ``others``, all further columns, so that no name of theirs meets an operator's own."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *([F.struct(*rest).alias("others")] if rest else []))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that were packed, in their order."""
    return rows.select(*(F.col(c) if c in ("doc_id", "text") else F.col("others").getField(c).alias(c) for c in columns))


def widened(df: DataFrame, added: str) -> T.StructType:
    """The schema of ``df`` with further columns."""
    return T.StructType(df.schema.fields + T.StructType.fromDDL(added).fields)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is read."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(steps: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states of a fold behind each element, block by block: no array grows beyond a block or the number of blocks."""
    def states(block, first):
        def grow(acc, x):
            return once(step(acc["state"], x), lambda s: F.struct(s.alias("state"), F.concat(acc["out"], F.array(s)).alias("out")))
        return F.aggregate(block, F.struct(first.alias("state"), F.slice(F.array(first), 1, 0).alias("out")), grow, lambda acc: acc["out"])

    def each(blocks):
        start = F.struct(zero.alias("state"), F.slice(F.array(zero), 1, 0).alias("out"))
        firsts = F.aggregate(blocks, start, lambda acc, block: F.struct(
            F.aggregate(block, acc["state"], step).alias("state"), F.concat(acc["out"], F.array(acc["state"])).alias("out")), lambda acc: acc["out"])
        return F.flatten(F.zip_with(blocks, firsts, states))
    return once(steps, lambda s: once(_blocks(s), each))


def _blocks(array: Column) -> Column:
    count = F.floor((F.size(array) - 1) / _BLOCK)
    return F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(0)).cast("int")), lambda b: F.slice(array, b * _BLOCK + 1, _BLOCK))


def cut(text: Column, ranges: Column, between: str = "") -> Column:
    """The text without ``ranges``, (a, b) in characters, disjoint and in order; each leaves ``between``."""
    def part(blocks, a, b):
        joined = F.array_join(F.slice(blocks, F.floor(a / _CHARS).cast("int") + 1, F.floor((b - 1) / _CHARS).cast("int") - F.floor(a / _CHARS).cast("int") + 1), "")
        return F.when(b > a, joined.substr(a % _CHARS + 1, b - a)).otherwise(F.lit(""))

    def joined(blocks):
        starts = F.concat(F.array(F.lit(0)), F.transform(ranges, lambda r: r["b"]))
        ends = F.concat(F.transform(ranges, lambda r: r["a"]), F.array(F.length(text)))
        return F.array_join(F.zip_with(starts, ends, lambda a, b: part(blocks, a, b)), between)
    return once(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHARS}}}"), F.lit(0)), joined)


def map_batches(df: DataFrame, schema: str | T.StructType, each: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Apply ``each`` to every Arrow batch."""
    def run(batches):
        for batch in batches:
            yield from each(batch)
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def record_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
                                      names=list(columns))


def components(edges: DataFrame, a: str, b: str, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Each round takes the smallest label among a node's neighbours and then jumps to that label's own label, so
    the number of rounds follows the logarithm of the longest path. Sums and minima are partial aggregates and
    the joins have no hot side that AQE could not split. Rounds are written to the shared folder, which cuts
    the lineage, and removed when the next one stands; the driver sees one number per round.
    """
    rounds = Rounds(edges.sparkSession)
    both = rounds.stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
                 .union(edges.select(F.col(b), F.col(a))).filter("u <> v").distinct(), f"{label}-edges")
    labels = rounds.stage(both.groupBy("u").agg(F.min("v").alias("v"))
                   .select(F.col("u").alias("node"), F.least("u", "v").alias("component")), f"{label}-0")
    held = labels
    while True:
        near = (both.join(labels, both["v"] == labels["node"]).groupBy("u")
                .agg(F.min("component").alias("near")))
        hooked = (labels.join(near, labels["node"] == near["u"])
                  .select("node", "component", F.least("component", "near").alias("new")))
        roots = labels.select(F.col("node").alias("root"), F.col("component").alias("jump"))
        after = rounds.stage(hooked.join(roots, hooked["new"] == roots["root"])
                      .select("node", F.least("new", "jump").alias("component"),
                              (F.least("new", "jump") < F.col("component")).alias("moved")), label)
        rounds.drop(held)
        held, labels = after, after.select("node", "component")
        if not after.filter("moved").limit(1).count():
            rounds.drop(both)
            return labels
