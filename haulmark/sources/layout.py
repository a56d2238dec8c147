"""A clustered layout that serves lookups by several columns: files along a Z-order curve, with a file index.

Each column is cut into cells of about equal row counts, by bounds from a sample; a value's cell number is the number of
bounds up to it. The bits of a row's cell numbers, taken in turn, are its place on the curve, and files are consecutive
ranges of it, so a file covers few cells of every column instead of few of the first one. Beside the files lie the bounds
and, per file, the least and greatest cell of each column. A lookup turns its conditions into cells, picks the files whose
cells meet all of them, and opens only these; the conditions themselves are then checked on the rows.

Nulls have cell 0 and are found by no condition but ``None``. The sample (``SAMPLE`` rows in the mean, of these columns only)
decides the shape of the files, never which rows a lookup returns.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.session import new_path
from haulmark.sources.commits import Commits
from haulmark.sources.writes import file_sizes

SAMPLE = 20_000
BITS = 8  # a column has at most 2^8 cells
_c = F.col


def _bounds(rows: DataFrame, columns: list[str]) -> tuple[dict[str, list], dict[str, list[int]]]:
    """Up to 2^BITS - 1 bounds per column, distinct and ascending, and the share of rows below each in 2^-BITS."""
    total = max(1, rows.count())
    sample = rows.select(*columns).sample(min(1.0, SAMPLE / total), seed=7).collect()
    bounds, shares = {}, {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        cuts = [values[len(values) * k >> BITS] for k in range(1, 1 << BITS)] if values else []
        bounds[c] = sorted(set(cuts))
        shares[c] = [cuts.index(b) for b in bounds[c]]
    return bounds, shares


def _cell(column: str, bounds: list, kind: T.DataType) -> Column:
    if not bounds:
        return F.lit(0)
    cuts = F.array(*(F.lit(b).cast(kind) for b in bounds))
    return F.when(_c(column).isNull(), 0).otherwise(F.size(F.filter(cuts, lambda b: b <= _c(column))))


def _place(cells: list[Column], shares: list[list[int]]) -> Column:
    """The bits of the rows' shares in turn, the highest first. Shares use all bits, also where there are few cells."""
    ranks = [F.when(cell == 0, 0).otherwise(F.get(F.array(*map(F.lit, share)), cell - 1)) if share else F.lit(0)
             for cell, share in zip(cells, shares)]
    bits = [F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(ranks) + len(ranks) - 1 - i)
            for bit in range(BITS) for i, rank in enumerate(ranks)]
    return reduce(Column.bitwiseOR, bits)


class Clustered:
    """A stored table that is clustered by some of its columns."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, bounds: dict[str, list]):
        self.spark, self.path, self.schema, self.bounds = spark, path, schema, bounds

    @staticmethod
    def write(df: DataFrame, path: str, columns: list[str], file_bytes: int = 512 << 20) -> Clustered:
        """Write ``df`` below ``path`` in files of about ``file_bytes``."""
        spark = df.sparkSession
        plain = new_path(spark, "unclustered")
        df.write.parquet(plain)  # a plan would run once for the bounds, once for the ranges and once for the files
        rows = spark.read.schema(df.schema).parquet(plain)
        bounds, shares = _bounds(rows, columns)
        cells = {c: _cell(c, bounds[c], df.schema[c].dataType) for c in columns}
        files = max(1, -(-(file_sizes(spark, plain).agg({"length": "sum"}).first()[0] or 0) // file_bytes))
        # Rows of one place are spread by the remaining order, so a crowded cell does not become one file.
        order = ["__z", *columns]
        (rows.withColumn("__z", _place(list(cells.values()), list(shares.values()))).repartitionByRange(files, *order).sortWithinPartitions(*order)
         .drop("__z").write.parquet(f"{path}/rows"))
        table = Clustered(spark, path, df.schema, bounds)
        extents = [F.struct(F.min(cell).alias("low"), F.max(cell).alias("high")).alias(c) for c, cell in cells.items()]
        table.all().groupBy(_c("_metadata.file_path").alias("file")).agg(*extents).coalesce(1).write.parquet(f"{path}/extents")
        Commits(spark, f"{path}/about").try_commit(1, {"schema": df.schema.jsonValue(),
                                                       "bounds": {c: [str(v) for v in b] for c, b in bounds.items()}})
        return table

    @staticmethod
    def open(spark: SparkSession, path: str) -> Clustered:
        about = Commits(spark, f"{path}/about").read(1)
        schema = T.StructType.fromJson(about["schema"])
        typed = {}
        for c, texts in about["bounds"].items():  # cast back by Spark: one row with an array per column
            typed[c] = spark.range(1).select(F.from_json(F.lit(json.dumps(texts)), "array<string>")
                                             .cast(T.ArrayType(schema[c].dataType)).alias("b")).first()["b"]
        return Clustered(spark, path, schema, typed)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")

    def _cells(self, column: str, condition) -> tuple[int, int]:
        """First and last cell in which values that meet a condition can lie."""
        if condition is None:
            return 0, 0
        low, high = condition if isinstance(condition, tuple) else (condition, condition)
        bounds = self.bounds[column]
        return (0 if low is None else bisect_right(bounds, low)), (len(bounds) if high is None else bisect_right(bounds, high))

    def files(self, **conditions) -> list[str]:
        """The files that may hold rows for the conditions."""
        found = self.spark.read.parquet(f"{self.path}/extents")
        for column, condition in conditions.items():
            low, high = self._cells(column, condition)
            found = found.filter((_c(column)["low"] <= high) & (_c(column)["high"] >= low))
        return sorted(r["file"] for r in found.select("file").collect())  # one row per file

    def lookup(self, **conditions) -> DataFrame:
        """Rows that meet all conditions: a value, ``None`` for null, or (least, greatest) with ``None`` for an open end."""
        files = self.files(**conditions)
        rows = self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)
        for column, condition in conditions.items():
            kind = self.schema[column].dataType
            if condition is None:
                rows = rows.filter(_c(column).isNull())
                continue
            low, high = condition if isinstance(condition, tuple) else (condition, condition)
            if low is not None:
                rows = rows.filter(_c(column) >= F.lit(low).cast(kind))
            if high is not None:
                rows = rows.filter(_c(column) <= F.lit(high).cast(kind))
        return rows
