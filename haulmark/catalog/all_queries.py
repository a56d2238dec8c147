"""Imports every family of queries, which registers them."""

from haulmark.catalog import (  # noqa: F401
    business, filters, joining, operations, quality_checks, scalar, scans, streams, summaries,
)
from haulmark.catalog.registry import ORACLES, PLANS, run  # noqa: F401
