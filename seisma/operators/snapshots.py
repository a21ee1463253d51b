"""Day tables whose readers always see one whole snapshot.

A table is a folder of immutable day folders and a log of manifests:

    <root>/data/commit=<id>/<date_col>=<day>/part-*.parquet
    <root>/log/<version>.json      which commit holds each day, and what changed

A commit writes the rebuilt days into a fresh folder and then renames one
manifest into place; the rename fails when another writer took the version
first (``SnapshotConflict``).  A run that dies at any point leaves the table as
it was before or as it is after, never a missing day or a key in two days;
folders that no manifest names are invisible, and ``vacuum`` removes them.

The manifest is also the log of touched days: ``changed_since`` gives the days
that differ between two versions, which is what incremental models rebuild.  It
holds an entry for each calendar day, so it stays small however large the days are.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


class SnapshotConflict(RuntimeError):
    """Another writer committed the version first; read again and repeat the merge."""


def in_days(col: str, days: Iterable[dt.date | None]) -> Column:
    """``col`` is one of ``days``; None stands for the NULL day."""
    days = list(days)
    known = [d for d in days if d is not None]
    return F.col(col).isin(known) | F.col(col).isNull() if None in days else F.col(col).isin(known)


class DayTable:
    """A day-partitioned Parquet table read and written by snapshots."""

    def __init__(self, spark: SparkSession, root: str, date_col: str = "event_date"):
        self.spark, self.root, self.date_col = spark, root.rstrip("/"), date_col
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)
        # FileContext's rename refuses an existing target, which the older interface does not promise
        qualified = self._fs.makeQualified(self._path(self.root))
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf)

    # manifests

    def versions(self) -> list[int]:
        """Committed versions, ascending."""
        log = self._path(f"{self.root}/log")
        if not self._fs.exists(log):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(log))
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def version(self) -> int | None:
        """The newest version; None before the first commit."""
        found = self.versions()
        return found[-1] if found else None

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version (the newest by default); an empty one before the first commit."""
        version = self.version() if version is None else version
        if version is None:
            return {"version": None, "days": {}, "changed": [], "note": {}, "schema": None}
        return json.loads(self.spark.read.text(self._file(version), wholetext=True).first()[0])

    def _file(self, version: int) -> str:
        return f"{self.root}/log/{version:012d}.json"

    def days(self, version: int | None = None) -> list[dt.date | None]:
        return [_day(d) for d in self.manifest(version)["days"]]

    def changed_since(self, version: int | None, until: int | None = None) -> list[dt.date | None]:
        """Days whose folder differs between ``version`` (None: the empty table) and ``until`` (the newest)."""
        old = self.manifest(version)["days"] if version is not None else {}
        new = self.manifest(until)["days"]
        return [_day(d) for d in sorted({*old, *new}) if old.get(d) != new.get(d)]

    # rows

    def read(self, version: int | None = None, days: Iterable[dt.date | None] | None = None) -> DataFrame:
        """Rows of one version, of the given days only where ``days`` is given: other folders are not even listed."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"no version of {self.root} has been committed")
        schema = StructType.fromJson(m["schema"])
        wanted = m["days"] if days is None else {d: c for d in {_name(x) for x in days} if (c := m["days"].get(d))}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.root}/data/commit={c}/{self.date_col}={d}" for d, c in sorted(wanted.items())]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*folders).select(*schema.names)

    def stage(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Write ``rows`` once, each task its own files, as a folder that no version names yet; returns it and its rows.

        ``replace`` may commit whole days of it as they are.
        """
        commit = uuid.uuid4().hex[:16]
        folder = f"{self.root}/data/commit={commit}"
        rows.write.partitionBy(self.date_col).parquet(folder)
        return commit, self.spark.read.schema(rows.schema).parquet(folder).select(*rows.columns)

    def replace(self, rows: DataFrame | None, days: Iterable[dt.date | None], base: int | None = None, note: dict | None = None,
                staged: tuple[str, Iterable[dt.date | None]] | None = None, schema: StructType | None = None) -> int:
        """Commit ``rows`` as the whole content of ``days`` on top of version ``base``; other days stay.

        A day without rows leaves the table.  Days named with a ``staged`` folder are committed from there,
        without being written again; with nothing else to write ``rows`` is None and ``schema`` is given.
        Returns the new version.
        """
        days = {_name(d) for d in days}
        found = {}
        if rows is not None:
            commit = uuid.uuid4().hex[:16]
            folder = f"{self.root}/data/commit={commit}"
            self._write(rows, folder)
            found = dict.fromkeys(self._folders(folder), commit)
        if found.keys() - days:
            raise ValueError(f"rows of days that are not being replaced: {sorted(found.keys() - days)}")
        if staged is not None:
            have, as_staged = self._folders(f"{self.root}/data/commit={staged[0]}"), {_name(d) for d in staged[1]}
            if as_staged & days:
                raise ValueError(f"days both staged and written: {sorted(as_staged & days)}")
            found, days = found | dict.fromkeys(as_staged & have, staged[0]), days | as_staged
        old = self.manifest(base) if base is not None else {"days": {}, "note": {}}
        held = {d: c for d, c in old["days"].items() if d not in days} | {d: found[d] for d in sorted(found)}
        version = 0 if base is None else base + 1
        self._publish(version, {"version": version, "days": held, "changed": sorted(days), "note": old["note"] | (note or {}), "schema": (schema or rows.schema).jsonValue()})
        return version

    def _folders(self, folder: str) -> set[str]:
        """Names of the days that a data folder holds."""
        return {s.getPath().getName().split("=", 1)[1] for s in self._fs.listStatus(self._path(folder)) if s.isDirectory()}

    def create(self, rows: DataFrame, note: dict | None = None) -> int:
        """The first version: all days of ``rows`` (which have ``date_col``)."""
        days = [r[0] for r in rows.select(self.date_col).distinct().collect()]  # calendar days
        return self.replace(rows, days, None, note)

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.hint("rebalance", self.date_col).write.partitionBy(self.date_col).parquet(folder)

    def _publish(self, version: int, manifest: dict) -> None:
        """Write the manifest beside its place, then rename it: the one step that readers can see."""
        new = self._path(f"{self.root}/log/.{version:012d}-{uuid.uuid4().hex[:8]}")
        self._fs.mkdirs(new.getParent())
        out = self._fs.create(new, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        self._rename(new, self._path(self._file(version)), version)

    def _rename(self, new, place, version: int) -> None:
        kinds = self.spark.sparkContext._gateway.new_array(getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self._context.rename(self._fs.makeQualified(new), self._fs.makeQualified(place), kinds)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                raise SnapshotConflict(f"version {version} of {self.root} was committed by another writer") from None
            raise

    def vacuum(self, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
        """Remove data folders that none of the last ``keep`` versions names and that are older than ``older_than``
        (a running commit's folder has no manifest yet), and the manifests before those versions."""
        versions = self.versions()
        used = {c for v in versions[-keep:] for c in self.manifest(v)["days"].values()}
        limit = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
        data, gone = self._path(f"{self.root}/data"), []
        for s in self._fs.listStatus(data) if self._fs.exists(data) else []:
            name = s.getPath().getName()
            if name.startswith("commit=") and name.removeprefix("commit=") not in used and s.getModificationTime() <= limit:
                self._fs.delete(s.getPath(), True)
                gone.append(name)
        for v in versions[:-keep]:
            self._fs.delete(self._path(self._file(v)), False)
        return gone


def _name(day: dt.date | None) -> str:
    return _NULL_DAY if day is None else day.isoformat()


def _day(name: str) -> dt.date | None:
    return None if name == _NULL_DAY else dt.date.fromisoformat(name)
