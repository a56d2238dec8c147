"""Table changes as new snapshots: updates, deletes and self references never rewrite in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_from(target: DataFrame, updates: DataFrame, key: str, columns: list[str],
                prefer: list[str] | None = None) -> DataFrame:
    """Take ``columns`` from the matching update, keep the old value elsewhere.

    Several updates of one key are reduced first: the one that is last by ``prefer`` wins (without
    ``prefer`` the columns themselves decide), so the result does not depend on row order.
    """
    ranked = F.struct(*(prefer or columns))
    picked = updates.groupBy(key).agg(F.max_by(F.struct(*columns), ranked).alias("__new"))
    joined = target.join(picked, key, "left")
    for name in columns:
        joined = joined.withColumn(name, F.coalesce(F.col("__new")[name], F.col(name)))
    return joined.drop("__new")


def override(base: Column, rules: list[tuple[Column, Column]]) -> Column:
    """Rules applied one after the other; a later rule overrides an earlier one."""
    value = base
    for condition, result in rules:
        value = F.when(condition, result).otherwise(value)
    return value


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Delete matching rows; rows for which the condition is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def resolve_parent(df: DataFrame, code: str, parent_code: str, key: str, parent_key: str) -> DataFrame:
    """Second pass of a self-referencing load: parent business code -> parent key."""
    lookup = df.select(F.col(code).alias("__code"), F.col(key).alias(parent_key))
    return df.join(lookup, df[parent_code] == F.col("__code"), "left").drop("__code")


def with_null_columns(df: DataFrame, **types: str) -> DataFrame:
    """Add typed null columns."""
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items()])


def with_defaults(df: DataFrame, **defaults) -> DataFrame:
    """Fill missing values with their declared defaults."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
