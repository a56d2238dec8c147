"""Versioned tables: row-level changes beside the data files, and one manifest for all tables of a store.

A change writes new files only: rows to add, and for rows to remove a small file of (data file, row number). A commit
makes both part of the next version (``Commits``), so a reader follows one version for all tables, and every
older version stays readable. An update of one row writes one row and one removal; no data file is rewritten. Reads
scan files without removals as they are and join the others with theirs; ``merge`` rewrites only those others.

Writers do not wait for each other. A commit that finds newer versions compares what they changed with its own: a
removal of the same row, or a table replaced by one and touched by the other, is a ``Conflict`` and nothing happens;
other changes are taken on top. Rows that others add while a change is prepared are not seen by it (snapshot isolation).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.sources.commits import Commits
from haulmark.sources.writes import stage

_c = F.col
_FILE, _ROW = "__file", "__row"
_REMOVED = f"{_FILE} string, {_ROW} bigint"


class Conflict(RuntimeError):
    """Another writer has changed the same rows or table; nothing was committed."""


class PublishError(RuntimeError):
    """A load broke one of its checks; nothing was published."""


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


class Store:
    """The tables below a folder. Without a version, the newest one is read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.commits = Commits(spark, f"{self.root}/_versions")

    def version(self) -> int:
        return self.commits.latest()

    def state(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        return self.commits.read(version)["tables"] if version else {}

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self._located(name, self.state(version)).drop(_FILE, _ROW)

    def files(self, name: str, version: int | None = None) -> list[str]:
        """The data files of a table."""
        table = self.state(version)[name]
        return self._kept(table, T.StructType.fromJson(table["schema"]))

    def _kept(self, table: dict, schema: T.StructType) -> list[str]:
        listed = self.spark.read.schema(schema).parquet(*table["data"]).inputFiles()
        return sorted(f for f in listed if _name(f) not in table["dropped"])

    def _located(self, name: str, state: dict) -> DataFrame:
        """The rows of a table with their data file and place in it."""
        if name not in state:
            raise KeyError(name)
        table = state[name]
        schema = T.StructType.fromJson(table["schema"])

        def scan(paths: list[str]) -> DataFrame:
            return self.spark.read.schema(schema).parquet(*paths).select(
                "*", _c("_metadata.file_name").alias(_FILE), _c("_metadata.row_index").alias(_ROW))
        touched = {f for removal in table["removed"] for f in removal["files"]}
        if not touched and not table["dropped"]:
            return scan(table["data"])
        kept = self._kept(table, schema)
        plain, dirty = [f for f in kept if _name(f) not in touched], [f for f in kept if _name(f) in touched]
        gone = self.removed(table)
        parts = ([scan(plain)] if plain else []) + ([scan(dirty).join(gone, [_FILE, _ROW], "left_anti")] if dirty else [])
        if not parts:
            return self.spark.createDataFrame([], schema).select("*", F.lit("").alias(_FILE), F.lit(0).cast("long").alias(_ROW))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def removed(self, table: dict) -> DataFrame:
        folders = [removal["folder"] for removal in table["removed"]]
        return self.spark.read.schema(_REMOVED).parquet(*folders) if folders else self.spark.createDataFrame([], _REMOVED)

    def change(self) -> Change:
        """A change on top of the newest version."""
        return Change(self)


class Change:
    """What one writer adds, removes and replaces; ``commit`` makes it a version, for all tables at once.

    All parts see the version that the change began with, not each other.
    """

    def __init__(self, store: Store):
        self.store, self.base = store, store.version()
        self.before = store.state(self.base)
        self.parts: dict[str, dict] = {}

    def _part(self, name: str) -> dict:
        return self.parts.setdefault(name, {"added": [], "removed": [], "dropped": [], "replaced": False})

    def _write(self, df: DataFrame, name: str, kind: str) -> str:
        folder = f"{self.store.root}/{name}/{kind}-{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return folder

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """The table becomes ``df``. Returns the rows as they were written, for checks before the commit."""
        part = self._part(name)
        folder = self._write(df, name, "data")
        part.update(added=[folder], removed=[], dropped=[], replaced=True, schema=df.schema.jsonValue())
        return self.store.spark.read.schema(df.schema).parquet(folder)

    def append(self, name: str, df: DataFrame) -> None:
        columns = T.StructType.fromJson(self.before[name]["schema"]).fieldNames()
        self._part(name)["added"].append(self._write(df.select(*columns), name, "data"))

    def _remove(self, name: str, hits: DataFrame) -> None:
        files = [r[0] for r in hits.select(_FILE).distinct().collect()]  # one row per data file
        if files:
            self._part(name)["removed"].append({"folder": self._write(hits.select(_FILE, _ROW), name, "removed"), "files": sorted(files)})

    def delete(self, name: str, condition: Column) -> None:
        """Rows for which the condition is unknown stay."""
        self._remove(name, stage(self.store._located(name, self.before).filter(condition).select(_FILE, _ROW), "removed"))

    def update(self, name: str, condition: Column, values: Mapping[str, Column]) -> None:
        """New values, from the old ones, for the rows of a condition."""
        self._rewrite(name, self.store._located(name, self.before).filter(condition), values)

    def update_from(self, name: str, updates: DataFrame, key: str, columns: list[str], prefer: list[str] | None = None) -> None:
        """Take ``columns`` from the update of the same key where they differ; null values leave the old one.

        Of several updates of a key the one that is last by ``prefer`` wins (without it the columns themselves decide).
        """
        picked = updates.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*(prefer or columns))).alias("__new"))
        values = {c: F.coalesce(_c("__new")[c], _c(c)) for c in columns}
        differs = F.lit(False)
        for c in columns:
            differs = differs | ~values[c].eqNullSafe(_c(c))
        self._rewrite(name, self.store._located(name, self.before).join(picked, key).filter(differs), values)

    def _rewrite(self, name: str, hits: DataFrame, values: Mapping[str, Column]) -> None:
        schema = T.StructType.fromJson(self.before[name]["schema"])
        new = [(values[f.name] if f.name in values else _c(f.name)).cast(f.dataType).alias(f.name) for f in schema]
        found = stage(hits.select(_FILE, _ROW, *new), "rewritten")  # both sides of the change come from one reading
        self._remove(name, found)
        if name in self.parts and self.parts[name]["removed"]:
            self._part(name)["added"].append(self._write(found.drop(_FILE, _ROW), name, "data"))

    def merge(self, name: str) -> None:
        """Write the data files that have removals anew, without the removed rows."""
        table = self.before[name]
        touched = sorted({f for removal in table["removed"] for f in removal["files"]})
        if touched:
            rows = self.store._located(name, self.before).filter(_c(_FILE).isin(touched)).drop(_FILE, _ROW)
            part = self._part(name)
            part["added"].append(self._write(rows, name, "data"))
            part["dropped"] = touched

    def _check(self, version: int) -> None:
        """Raise when what a newer version did and this change exclude each other."""
        theirs = self.store.commits.read(version)["changed"]
        for name in theirs.keys() & self.parts.keys():
            a, b = theirs[name], self.parts[name]
            said = f"version {version} changed {name!r}"
            if a["replaced"] or b["replaced"]:
                raise Conflict(f"{said}, which one of the two replaces")
            mine, others = ({f for r in p["removed"] for f in r["files"]} for p in (b, a))
            if (mine | set(b["dropped"])) & set(a["dropped"]) or others & set(b["dropped"]):
                raise Conflict(f"{said} in files that one of the two merges")
            if mine & others:
                both = self.store.removed(a).join(self.store.removed(b), [_FILE, _ROW], "left_semi")
                if both.limit(1).count():
                    raise Conflict(f"{said} in the same rows")

    def _applied(self, state: dict) -> dict:
        tables = dict(state)
        for name, part in self.parts.items():
            old = {"data": [], "removed": [], "dropped": []} if part["replaced"] else tables[name]
            gone = set(part["dropped"])
            # Removals of files that are merged have done their work.
            left = [{**r, "files": [f for f in r["files"] if f not in gone]} for r in old["removed"]]
            tables[name] = {"schema": part.get("schema") or old["schema"], "data": old["data"] + part["added"],
                            "removed": [r for r in left if r["files"]] + part["removed"], "dropped": sorted(set(old["dropped"]) | gone)}
        return tables

    def commit(self) -> int:
        """Make the change the next version and return its number; ``Conflict`` where another writer was in the way."""
        at = self.base
        while True:
            newest = self.store.version()
            for version in range(at + 1, newest + 1):
                self._check(version)
            at = newest
            document = {"tables": self._applied(self.store.state(at)), "changed": self.parts}
            if self.store.commits.try_commit(at + 1, document):
                return at + 1


def publish(store: Store, tables: dict[str, DataFrame], violations: Callable[[dict[str, DataFrame]], int]) -> int:
    """Write all tables, check what was written, and make it current by one commit. Returns the version.

    Readers see either the whole load or none of it. Of two loads of one table that overlap, the second to commit fails.
    """
    change = store.change()
    staged = {name: change.replace(name, df) for name, df in tables.items()}
    broken = violations(staged)
    if broken:
        raise PublishError(f"{broken} violations; the load stays unpublished")
    return change.commit()
