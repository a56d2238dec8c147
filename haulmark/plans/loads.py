"""Loading the tables in the order of their references."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from haulmark.session import new_path
from haulmark.sources.writes import counted_write

# A table comes after every table it refers to.
LOAD_ORDER = [
    "addresses", "customers", "business_accounts", "business_contacts", "account_addresses",
    "facilities", "service_zones", "zone_postal_codes", "routes",
    "employees", "drivers", "vehicles", "assignments", "rate_cards",
    "shipments", "packages", "freight_bills", "pallets", "tracking_events",
    "invoices", "invoice_lines", "payments",
]


class Warehouse(Mapping):
    """The stored tables by name. A table is written when it is first asked for, and only once."""

    def __init__(self, lake) -> None:
        self._lake = lake
        self._root = new_path(lake.spark, "warehouse")
        self._tables: dict[str, DataFrame] = {}
        self._counts: dict[str, int] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in LOAD_ORDER:
            raise KeyError(name)
        if name not in self._tables:
            df, path = self._lake.derive(name), f"{self._root}/{name}"
            self._counts[name] = counted_write(df, path)
            self._tables[name] = self._lake.spark.read.schema(df.schema).parquet(path)
        return self._tables[name]

    def view(self, name: str) -> DataFrame:
        """The stored table where there is one, else the plan that makes it: for steps that read it once."""
        if name not in LOAD_ORDER:
            raise KeyError(name)
        return self._tables[name] if name in self._tables else self._lake.derive(name)

    def __iter__(self) -> Iterator[str]:
        return iter(LOAD_ORDER)

    def __len__(self) -> int:
        return len(LOAD_ORDER)

    def load_all(self) -> dict[str, int]:
        """Load what is not loaded yet, in dependency order; returns the rows written per table."""
        for name in LOAD_ORDER:
            self[name]
        return {name: self._counts[name] for name in LOAD_ORDER}
