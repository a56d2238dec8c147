"""Joins that hold for hot keys and for intervals.

No side is forced to be broadcast: Catalyst and AQE do that where the measured size allows it. Where both
sides are shuffled, AQE splits a hot partition, but only on a side that the join type lets it split: both
sides of an inner join, the kept side of an outer join, the left side of a semi or anti join. The helpers
below keep the side that can be hot on such a place. Interval joins carry an equality key, so none is
planned as a nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys_of(other: DataFrame, key: str) -> DataFrame:
    """The distinct keys, made behind the exchange: before it, a task would hold all keys of its part of the input."""
    return other.select(key).repartition(key).distinct()


def found_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Semi join. The other side is reduced to its keys first, so its hot keys are single rows."""
    return df.join(_keys_of(other, key), key, "left_semi")


def missing_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Anti join, with the other side reduced to its keys."""
    return df.join(_keys_of(other, key), key, "left_anti")


def left_join_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """Left outer join where the right side may hold a hot key.

    The matches are an inner join, which can be split on either side; rows without a match are added to it.
    """
    alone = missing_in(one, many, key)
    return one.join(many, key).unionByName(alone, allowMissingColumns=True)


def range_join(facts: DataFrame, ranges: DataFrame, value: str, low: str, high: str, keys: list[str],
               cell: int, how: str = "inner") -> DataFrame:
    """Match integer ``value`` to [low, high] within equal ``keys``.

    The value axis is cut into cells: a range is listed once per cell it touches, a fact meets only the
    ranges of its own cell, and the exact bounds are checked after that. A value lies in one cell, so no
    pair can be found twice.
    """
    spread = ranges.withColumn(
        "__cell", F.explode(F.sequence(F.expr(f"{low} div {cell}"), F.expr(f"{high} div {cell}"))))
    celled = facts.withColumn("__cell", F.expr(f"{value} div {cell}"))
    left, right = celled.alias("f"), spread.alias("r")
    match = F.col(f"f.{value}").between(F.col(f"r.{low}"), F.col(f"r.{high}"))
    for name in [*keys, "__cell"]:
        match = match & (F.col(f"f.{name}") == F.col(f"r.{name}"))
    extra = [F.col(f"r.{c}") for c in ranges.columns if c not in keys]
    return left.join(right, match, how).select(*[F.col(f"f.{c}") for c in facts.columns], *extra)


def effective_join(facts: DataFrame, history: DataFrame, on_date: Column, keys: list[str],
                   start: str = "effective_from", end: str = "effective_to", how: str = "inner",
                   also: Column | None = None) -> DataFrame:
    """Match the history row in force on a date; both ends are inclusive, a null end is still open.

    ``also`` is a further condition on both sides, named f (facts) and h (history).
    ``on_date`` must be a DATE: a timestamp on the last day would fall behind that day's midnight.
    """
    dated = facts.withColumn("__on", on_date.cast("date"))
    match = (F.col("h." + start) <= F.col("f.__on")) & (
        F.col("h." + end).isNull() | (F.col("f.__on") <= F.col("h." + end)))
    for name in keys:
        match = match & (F.col(f"f.{name}") == F.col(f"h.{name}"))
    match = match if also is None else match & also
    extra = [F.col(f"h.{c}") for c in history.columns if c not in keys]
    return (dated.alias("f").join(history.alias("h"), match, how)
            .select(*[F.col(f"f.{c}") for c in facts.columns], *extra))


def postal_zone_join(addresses: DataFrame, zones: DataFrame, how: str = "inner") -> DataFrame:
    """Postal code -> service zone over string ranges.

    Both sides are keyed by country and the first three characters. Five-digit ranges are listed once per
    three-digit prefix (at most 1,000 each); a Canadian range is its own three-character prefix, and a
    full Canadian code is compared by that prefix only.
    """
    first3 = F.left(F.col("postal_code"), F.lit(3))
    keyed = addresses.select(
        "*", first3.alias("__prefix"),
        F.when(F.col("country_code") == "CA", first3).otherwise(F.col("postal_code")).alias("__code"))
    low3, high3 = F.left("min_postal_code", F.lit(3)), F.left("max_postal_code", F.lit(3))
    digits = F.transform(F.sequence(F.try_to_number(low3, F.lit("999")).cast("int"),
                                    F.try_to_number(high3, F.lit("999")).cast("int")),
                         lambda p: F.lpad(p.cast("string"), 3, "0"))
    spread = zones.withColumn(
        "__prefix",
        F.explode(F.when(F.col("country_code") == "CA", F.array(low3)).otherwise(digits)))
    a, z = keyed.alias("a"), spread.alias("z")
    match = ((F.col("a.country_code") == F.col("z.country_code"))
             & (F.col("a.__prefix") == F.col("z.__prefix"))
             & F.col("a.__code").between(F.col("z.min_postal_code"), F.col("z.max_postal_code")))
    return a.join(z, match, how).select(*[F.col(f"a.{c}") for c in addresses.columns],
                                        F.col("z.zone_id"), F.col("z.zone_code"))
