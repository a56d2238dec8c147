"""Sequences that several tables and concurrent loads share, as a persisted ledger of reserved ranges.

A sequence is a folder of commits, one per load: who took which numbers, and the next free one. A load reserves all its
numbers by one commit, so the cost follows the number of loads, not of rows. Two loads that meet at one version are
told apart by the commit; the later one takes the numbers behind the earlier one's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.sources.commits import Commits

ENTRY = "sequence string, load string, first bigint, n bigint, next bigint"


class Ledger:
    """``start`` is the first number of every sequence of the ledger; sequences grow by one and never turn around."""

    def __init__(self, spark: SparkSession, root: str, start: int = 1):
        self.spark, self.root, self.start = spark, root, start

    def _commits(self, sequence: str) -> Commits:
        return Commits(self.spark, f"{self.root}/{sequence}")

    def reserve(self, sequence: str, load: str, count: int) -> int:
        """First of ``count`` consecutive numbers for a load; a load that asks again gets the same ones.

        A load that comes back with another number of rows is a mistake of the caller and is refused: its numbers may
        be in use already.
        """
        commits = self._commits(sequence)
        while True:
            entries = commits.table(ENTRY)
            before = entries.filter(F.col("load") == load).first()
            if before is not None:
                if before["n"] != count:
                    raise ValueError(f"load {load!r} of {sequence!r} has {before['n']} numbers and asks for {count}")
                return before["first"]
            version = commits.latest()
            first = commits.read(version)["next"] if version else self.start
            entry = {"sequence": sequence, "load": load, "first": first, "n": count, "next": first + count}
            if commits.try_commit(version + 1, entry):
                return first

    def ranges(self, sequence: str) -> DataFrame:
        """load, first, last and n of every reservation; last is null for a load without rows."""
        return self._commits(sequence).table(ENTRY).select(
            "load", "first", F.when(F.col("n") > 0, F.col("next") - 1).alias("last"), "n")
