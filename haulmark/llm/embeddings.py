"""Embedding near-duplicates by sorted projection passes.

Equal vectors of a label are one node. In each pass the nodes are ordered by label and then lexicographically by a row
of random hashes (random projections cut into steps), ended by a plain projection, and every vector is compared with
the ``WINDOW`` before it. Ranges of the order meet at their ends: each range hands its first and last vectors to a
second, small comparison. Pairs that pass are united over all passes. The number of passes grows with the logarithm of
the largest label, since a pass parts more pairs the closer the vectors of a label lie.

Links within a component are then counted exactly, in blocks of about ``BLOCK`` vectors against blocks, so that a
group larger than the windows has all its links counted, without a pair being written.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without label, link
with nothing and are their own component. Vectors of different lengths are never linked. Repeated rows count as
further vectors of their node. A component's id is its smallest vec_id that is not null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.common import components, map_batches, record_batch, stage

THRESHOLD = 0.98
PASSES = 8
HASHES = 10
STEP = 0.25
WINDOW = 24
BLOCK = 512
SEED = 20240917


def passes_for(largest: int) -> int:
    """Passes for a label of so many distinct vectors: PASSES up to about 8,000, 16 at 20,000, and 20 more per power of ten."""
    return max(PASSES, math.ceil(16 + 20 * math.log10(max(largest, 1) / 20_000)))


def _matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype=np.float64).reshape(len(vectors), -1)


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, node and the unit vector as bytes; node and unit are null where nothing can link."""
    usable = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))

    def each(batch):
        units = []
        for values, label in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
            unit = None
            if values and label is not None and None not in values:
                row = np.array(values, dtype=np.float64)
                if np.isfinite(row).all() and row.any():
                    row = row / np.abs(row).max()  # no overflow in the sum of squares
                    unit = (row / np.sqrt((row * row).sum())).tobytes()
            units.append(unit)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(units, pa.binary())],
                                         names=["vec_id", "label", "unit"])
    label_type = dict(usable.dtypes)["label"]
    units = map_batches(usable, f"vec_id long, label {label_type}, unit binary", each)
    node = F.when(F.col("unit").isNotNull(), F.xxhash64("label", "unit"))
    return stage(units.withColumn("node", node), "vectors")


def _with_key(nodes: DataFrame, turn: int) -> DataFrame:
    """The nodes with this pass's sort key: big-endian hashes and a projection, which order as bytes."""
    def each(batch):
        keys = []
        for unit in batch.column(2).to_pylist():
            row = np.frombuffer(unit, dtype=np.float64)
            rng = np.random.default_rng([SEED, turn, len(row)])
            if len(row) not in drawn:
                drawn[len(row)] = rng.standard_normal((HASHES + 1, len(row))), rng.uniform(0, STEP, HASHES + 1)
            directions, shift = drawn[len(row)]
            at = directions @ row + shift
            steps = np.floor(at[:-1] / STEP).astype(np.int64) + 32768
            fine = np.clip((at[-1] + 32) * 2 ** 40, 0, 2 ** 62).astype(np.int64)
            keys.append(len(row).to_bytes(4, "big") + np.clip(steps, 0, 65535).astype(">u2").tobytes() + int(fine).to_bytes(8, "big"))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, "key"])
    drawn: dict = {}
    schema = ", ".join(f"{n} {t}" for n, t in nodes.dtypes) + ", key binary"
    return map_batches(nodes, schema, each)


def _near(ids: np.ndarray, rows: np.ndarray, labels: list, held: int, least: float):
    """Pairs (later, earlier) at most WINDOW apart whose later one is at ``held`` or behind."""
    pairs = []
    for back in range(1, min(WINDOW, len(ids) - 1) + 1):
        first = max(held, back)
        dots = np.einsum("ij,ij->i", rows[first:], rows[first - back:len(rows) - back])
        for k in np.flatnonzero(dots >= least).tolist():
            if labels[first + k] == labels[first + k - back]:
                pairs.append((int(ids[first + k]), int(ids[first + k - back])))
    return pairs


_OUT = "kind int, a long, b long, cut int, place int, label string, unit binary"


def _out(pairs=(), edges=()) -> pa.RecordBatch:
    """Found pairs (kind 0), and vectors at the ends of a range (kind 1: before the cut, 2: after it)."""
    n = len(pairs)
    return record_batch(
        kind=pa.array([0] * n + [e[0] for e in edges], pa.int32()), a=pa.array([p[0] for p in pairs] + [e[1] for e in edges], pa.int64()),
        b=pa.array([p[1] for p in pairs] + [None] * len(edges), pa.int64()), cut=pa.array([None] * n + [e[2] for e in edges], pa.int32()),
        place=pa.array([None] * n + [e[3] for e in edges], pa.int32()), label=pa.array([None] * n + [e[4] for e in edges], pa.string()),
        unit=pa.array([None] * n + [e[5] for e in edges], pa.binary()))


def _windows(least: float):
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        tail: list[tuple] = []  # the last WINDOW rows so far: id, label, unit
        head = 0
        for batch in batches:
            fresh = list(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2)), strict=True))
            edges = [(2, i, part, head + k, str(label), unit) for k, (i, label, unit) in enumerate(fresh[:max(0, WINDOW - head)])]
            head += len(fresh)
            rows, pairs = tail + fresh, []
            # Runs of vectors of one length are compared; the order puts them together within a label.
            start = 0
            while start < len(rows):
                end = start + 1
                while end < len(rows) and len(rows[end][2]) == len(rows[start][2]):
                    end += 1
                run_of = rows[start:end]
                pairs += _near(np.array([r[0] for r in run_of]), _matrix([r[2] for r in run_of]), [r[1] for r in run_of],
                               max(0, len(tail) - start), least)
                start = end
            tail = rows[-WINDOW:]
            yield _out(pairs, edges)
        yield _out(edges=[(1, i, part + 1, k - len(tail), str(label), unit) for k, (i, label, unit) in enumerate(tail)])
    return run


def _across(least: float):
    """Pairs between the vectors before and after a cut; at most 2 * WINDOW vectors per cut."""
    def run(_key, rows):
        rows = rows.sort_values("place")
        pairs = []
        for _, same in rows.groupby(rows["unit"].map(len)):
            before = int((same["kind"] == 1).sum())
            pairs += [p for p in _near(same["a"].to_numpy(), _matrix(list(same["unit"])), list(same["label"]), before, least)]
        import pandas as pd
        return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")
    return run


def links_found(nodes: DataFrame, passes: int = PASSES, least: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b) of nodes that some pass compared and found similar."""
    spark = nodes.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = None
    for turn in range(passes):
        keyed = _with_key(nodes.select("node", "label", "unit"), turn)
        ordered = keyed.repartitionByRange(ranges, "label", "key").sortWithinPartitions("label", "key")
        out = ordered.select("node", "label", "unit").mapInArrow(_windows(least), _OUT).withColumn("turn", F.lit(turn))
        found = out if found is None else found.union(out)
    found = stage(found, "passes")
    inside = found.filter("kind = 0").select("a", "b")
    ends = found.filter("kind > 0").groupBy("turn", "cut").applyInPandas(_across(least), "a long, b long")
    return inside.union(ends).distinct()


def _count_blocks(least: float):
    """Links of each node, from rows (component, low, high, block, node, weight, unit) grouped by the first three."""
    def count(group):
        rows = _matrix([g[6] for g in group])
        block, weight = np.array([g[3] for g in group]), np.array([g[5] for g in group])
        close = rows @ rows.T >= least
        # A block with itself counts all but the node; two blocks count only across.
        np.fill_diagonal(close, False)
        if group[0][1] != group[0][2]:
            close &= block[:, None] != block[None, :]
        return [(g[4], int(n)) for g, n in zip(group, close @ weight, strict=True)]

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][:3] != row[:3]:
                    out += count(held)
                    held = []
                held.append(row)
            yield record_batch(node=pa.array([o[0] for o in out], pa.int64()), links=pa.array([o[1] for o in out], pa.int64()))
        out = count(held) if held else []
        yield record_batch(node=pa.array([o[0] for o in out], pa.int64()), links=pa.array([o[1] for o in out], pa.int64()))
    return run


def near_duplicates(embeddings: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    vectors = unit_vectors(embeddings)
    nodes = stage(vectors.filter("node IS NOT NULL").groupBy("node")
                  .agg(F.any_value(F.struct("label", "unit")).alias("held"), F.count(F.lit(1)).alias("weight"))
                  .select("node", "held.label", "held.unit", "weight"), "vector-nodes")
    largest = nodes.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    labels = components(links_found(nodes, passes_for(largest), least), "a", "b")
    members = stage(nodes.join(labels, "node"), "vector-members")
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    blocked = (members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
               .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))))
    key = ["component", "low", "high"]
    blocked = (blocked.select("component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                              "block", "node", "weight", "unit")
               .repartition(*key).sortWithinPartitions(*key))
    counted = (blocked.mapInArrow(_count_blocks(least), "node long, links long")
               .groupBy("node").agg(F.sum("links").alias("links")))
    placed = stage(vectors.join(nodes.select("node", "weight"), "node", "left").join(labels, "node", "left")
                   .join(counted, "node", "left")
                   .select("vec_id", "node", F.coalesce("component", "node").alias("component"),
                           (F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).alias("n_links")), "vector-placed")
    alone = placed.filter("component IS NULL").select("vec_id", "n_links", F.col("vec_id").alias("component_id"))
    grouped = placed.filter("component IS NOT NULL")
    smallest = grouped.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return (grouped.join(smallest, "component").select("vec_id", "n_links", "component_id").union(alone)
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
