"""Quotes, payment application, currency normalisation, hierarchy roll-up and row visibility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.functions import scalars as S
from haulmark.operators.joins import effective_join
from haulmark.operators.trees import walk_down

_c = F.col


def package_quotes(lake) -> DataFrame:
    """Price of a package: rate in force on the ship date for its tier and zone, plus the charge per kg.

    A package that no card covers, by date or weight, stays with a null quote.
    """
    boxes = lake.packages.select(
        "package_id", "service_tier", _c("origin_nation").alias("zone_id"), "created_at",
        S.billable_weight(_c("actual_weight_kg"), _c("dim_weight_kg")).alias("billable_kg"))
    inside = _c("f.billable_kg").between(_c("h.min_weight_kg"), _c("h.max_weight_kg"))
    rated = effective_join(boxes, lake.rate_cards.drop("rate_currency"), _c("created_at"), ["service_tier", "zone_id"],
                           how="left", also=inside)
    return rated.withColumn("quote", (_c("base_rate") + _c("per_kg") * _c("billable_kg")).cast("decimal(12,4)"))


def split_payments(lake) -> DataFrame:
    """Every fourth invoice is paid in two halves; of those, every second has only its first half so far."""
    i, amount = _c("invoice_id"), _c("amount_paid")
    half = (amount / F.lit(2).cast("decimal(1,0)")).cast("decimal(12,2)")
    rest = (amount - half).cast("decimal(12,2)")
    parts = (F.when(i % 4 != 0, F.array(amount)).when(i % 8 == 0, F.array(half)).otherwise(F.array(half, rest)))
    return lake.payments.select("invoice_id", F.posexplode(parts).alias("part", "paid"))


def applied_payments(lake) -> DataFrame:
    """Balance of every invoice and the status that follows from what has been paid."""
    paid = split_payments(lake).groupBy("invoice_id").agg(F.sum("paid").alias("paid"))
    zero = F.lit(0).cast("decimal(12,2)")
    joined = lake.invoices.join(paid, "invoice_id", "left").withColumn("paid", F.coalesce("paid", zero))
    balance = _c("total_amount") - _c("paid")
    status = (F.when((_c("paid") > 0) & (balance <= 0), "Paid").when(_c("paid") > 0, "PartiallyPaid")
              .otherwise(_c("invoice_status")))
    return joined.select("invoice_id", "total_amount", _c("paid").cast("decimal(12,2)").alias("paid"),
                         balance.cast("decimal(12,2)").alias("balance"), status.alias("status"))


def in_usd(df: DataFrame, amount: str, rate: str = "rate_to_usd") -> DataFrame:
    """Amount in USD at the rate stored with the row."""
    return df.withColumn("usd", (_c(amount) * _c(rate)).cast("decimal(18,2)"))


def facility_tree(lake) -> DataFrame:
    return walk_down(lake.facilities, "facility_id", "parent_facility_id")


def subtree_sizes(lake) -> DataFrame:
    """Facilities below each facility: every node counts once for each ancestor on its path.

    The tree has three levels, so a path never holds more than three keys.
    """
    ancestors = facility_tree(lake).select("node", F.explode(F.split("path", "/")).alias("ancestor"))
    return ancestors.groupBy(_c("ancestor").cast("long").alias("facility_id")).agg(
        (F.count(F.lit(1)) - 1).alias("below"))


def account_grants(lake) -> DataFrame:
    """Who may see which account: the employees of a nation see the accounts based there."""
    return lake.employees.select(_c("employee_number").alias("viewer"), "nation_id")


def visible_accounts(lake, viewer: str) -> DataFrame:
    granted = account_grants(lake).filter(_c("viewer") == viewer)
    return lake.business_accounts.join(granted, "nation_id", "left_semi")
