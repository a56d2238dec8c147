"""Column helpers. Each is a plain SQL expression, so it stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(key: Column, multiplier: int, salt: int, classes: int = 100) -> Column:
    """Repeatable class number of a key, 0 .. classes-1 (stands in for a random roll)."""
    return F.pmod(key * F.lit(multiplier) + F.lit(salt), F.lit(classes))


def weighted(roll: Column, bands: list[tuple[int, object]], last: object) -> Column:
    """Pick by cumulative upper bounds: the first band whose bound is above the roll."""
    bound, value = bands[0]
    picked = F.when(roll < bound, F.lit(value))
    for bound, value in bands[1:]:
        picked = picked.when(roll < bound, F.lit(value))
    return picked.otherwise(F.lit(last))


def zero_pad(number: Column, width: int) -> Column:
    """Left-pad with zeros and keep the last ``width`` digits (``lpad`` would keep the first)."""
    return F.right(F.concat(F.lit("0" * width), number.cast("string")), F.lit(width))


def zero_pad_least(number: Column, width: int) -> Column:
    """Left-pad with zeros to at least ``width`` digits; longer numbers stay whole, so different ones stay different."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def day_number(ts: Column) -> Column:
    """The date as the number yyyymmdd; arithmetic is cheaper here than formatting text."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)).cast("long")


def tracking_number(tier_code: Column, created_at: Column, sequence: Column) -> Column:
    """TL + tier letter + yyyyMMdd + HH + last five digits of the sequence: 18 characters.

    Date, hour and sequence are joined as one 15-digit number, so the inner zeros need no padding.
    """
    digits = (day_number(created_at) * 100 + F.hour(created_at)) * 100000 + F.pmod(sequence, F.lit(100000))
    return F.concat(F.lit("TL"), tier_code, digits.cast("string"))


def tracking_parts(number: Column) -> dict[str, Column]:
    """The parts a tracking number was made from."""
    return {
        "tier_code": F.substring(number, 3, 1),
        "ship_date": F.to_date(F.substring(number, 4, 8), "yyyyMMdd"),
        "ship_hour": F.substring(number, 12, 2).cast("int"),
        "sequence": F.substring(number, 14, 5).cast("int"),
    }


def dim_weight(length: Column, width: Column, height: Column) -> Column:
    """Dimensional weight in kg from whole centimetres: volume / 5000."""
    volume = length.cast("long") * width.cast("long") * height.cast("long")
    return (volume.cast("decimal(18,0)") * F.lit("0.0002").cast("decimal(4,4)")).cast("decimal(8,2)")


def billable_weight(actual: Column, dimensional: Column) -> Column:
    return F.greatest(actual, dimensional)


def successor(index: Column, size: Column | int) -> Column:
    """Next index of a 1-based pool, wrapping at its end."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.pmod(index, size) + F.lit(1)


def exactly_one(a: Column, b: Column) -> Column:
    """True where one of the two columns is set and the other is null."""
    return a.isNotNull() != b.isNotNull()


def add_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"))


def holds(rule: Column) -> Column:
    """A declared check as the database applies it: unknown counts as satisfied."""
    return F.coalesce(rule, F.lit(True))


def active(df, deleted_at: str = "deleted_at"):
    """Rows that are not soft-deleted."""
    return df.filter(F.col(deleted_at).isNull())
