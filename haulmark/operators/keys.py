"""Gap-free keys for tables of any size.

A global ``row_number`` would pull the table into one task. Here the rows are stored, range-partitioned and sorted
on the numbering order, written to the shared folder with their place in the partition, and given offsets from the
partition sizes. The written table fixes the partition layout, so a lost executor cannot change a number that was
already handed out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.session import new_path
from haulmark.sources.ledger import Ledger
from haulmark.sources.writes import file_sizes

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in its lower 33 bits
_RANGE_BYTES = 64 << 20  # stored (compressed) bytes of a range partition, small enough to sort in memory


def range_count(spark, path: str) -> int:
    """Ranges for a stored table, from the bytes of its files. The size of a plan would be a guess: for joins without
    statistics it is a product of sizes."""
    size = file_sizes(spark, path).agg({"length": "sum"}).first()[0] or 0
    return max(1, -(-size // _RANGE_BYTES))


def _placed(df: DataFrame, order: list[str], key: str, partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """The rows stored in order with __part and __row, and one row per range with the rows before it."""
    spark = df.sparkSession
    plain, path = new_path(spark, f"rows-{key}"), new_path(spark, f"keys-{key}")
    df.write.parquet(plain)
    rows = spark.read.schema(df.schema).parquet(plain)
    parts = partitions or range_count(spark, plain)
    # Up to the session's shuffle partitions their number is left open, so that AQE can put small ones together.
    few = not partitions and parts <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = ((rows.repartitionByRange(*order) if few else rows.repartitionByRange(parts, *order))
              .sortWithinPartitions(*order)
              .withColumn("__place", F.monotonically_increasing_id()))
    placed.write.parquet(path)

    stored = (spark.read.schema(placed.schema).parquet(path)
              .withColumn("__part", F.shiftright("__place", _ROW_BITS))
              .withColumn("__row", F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
              .drop("__place"))
    # One row per range partition: the size of this frame is bounded by the number of ranges, not by the data.
    sizes = stored.groupBy("__part").agg((F.max("__row") + 1).alias("__n"))
    running = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return stored, sizes.select("__part", "__n", F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__offset"))


def _numbered(stored: DataFrame, offsets: DataFrame, key: str, start: int) -> DataFrame:
    return (stored.join(F.broadcast(offsets.drop("__n")), "__part")
            .withColumn(key, F.col("__offset") + F.col("__row") + F.lit(start))
            .drop("__part", "__row", "__offset"))


def dense_keys(df: DataFrame, order: list[str], key: str, start: int = 1,
               partitions: int | None = None) -> DataFrame:
    """Add ``key`` = start, start+1, ... in the order of ``order`` (which must identify a row).

    ``df`` may be any plan; it runs once. It is written, so number narrow rows and join the rest on afterwards.
    """
    return _numbered(*_placed(df, order, key, partitions), key, start)


def dense_keys_by_group(df: DataFrame, order: list[str], key: str, start: int = 1) -> DataFrame:
    """The numbers of ``dense_keys`` for rows whose first column, never null, has a moderate number of rows per value.

    Only the counts per value are stored and put in order. The rows are exchanged once, by the first column, so a join on it
    that follows needs no exchange of its own. Rows equal in all of ``order`` are the only ones that can change places.
    """
    group = order[0]
    # Counted behind the exchange: values that hardly repeat would only fill the memory of the tasks before it.
    counts = df.select(group).repartition(group).groupBy(group).agg(F.count(F.lit(1)).alias("__rows"))
    stored, _ = _placed(counts, [group], key, None)
    sizes = stored.groupBy("__part").agg(F.sum("__rows").alias("__n"))
    before = (Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(*before)), F.lit(0)).alias("__offset"))
    inside = F.coalesce(F.sum("__rows").over(Window.partitionBy("__part").orderBy(group).rowsBetween(*before)), F.lit(0))
    first = (stored.withColumn("__inside", inside).join(F.broadcast(offsets), "__part")
             .select(group, (F.col("__offset") + F.col("__inside") + F.lit(start - 1)).alias("__first")))
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(group).orderBy(*order[1:])))
    return ranked.join(first, group).withColumn(key, F.col("__first") + F.col("__rank")).drop("__first", "__rank")


def sequence_keys(df: DataFrame, order: list[str], key: str, ledger: Ledger, sequence: str, load: str) -> DataFrame:
    """Number the rows of one load from a sequence that several tables and concurrent loads share.

    The range is reserved once the rows are stored and counted, so it has the load's exact size and leaves no gap. A load
    that is repeated under its name gets its range again.
    """
    stored, offsets = _placed(df, order, key, None)
    count = offsets.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    return _numbered(stored, offsets, key, ledger.reserve(sequence, load, count))


def high_water(existing: DataFrame, key: str) -> int:
    """Largest key handed out so far; numbering of the next load starts above it."""
    return existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).first()[0]


def append_keys(existing: DataFrame, new: DataFrame, order: list[str], key: str) -> DataFrame:
    """Number new rows above the keys of an existing table, by a single writer; ``sequence_keys`` serves several."""
    return dense_keys(new, order, key, start=high_water(existing, key) + 1)
