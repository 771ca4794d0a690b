"""Keyed tables of shared state, changed by compare-and-set.

A table is a log of commits: each names a folder of Parquet rows, either all rows of the table (a snapshot) or those that changed (a delta, whose rows
replace those of the same key, or take them out). A writer says which version it read; its commit is the file of the next number, which is created
only if nobody else has. The loser reads again and tries again, so no change is lost and what a commit costs depends on what changes, not on what
the table holds; every COMPACT deltas the rows are gathered into a snapshot. Readers see whole commits only."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dialect import desc, latest_by
from millrace.sources import bronze

#: Snapshots, with the deltas after them, that stay for slow readers; deltas after which a snapshot is made; times that a change is tried.
KEEP_VERSIONS, COMPACT, TRIES = 3, 16, 50
GONE = "__gone"


class Conflict(RuntimeError):
    """Somebody else has made the next version."""


class StateTable:
    """Rows of ``schema`` (SQL text), one for each value of ``key``, its first column unless said otherwise."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str | None = None):
        self.spark, self.path, self.schema = spark, path, schema
        self.names = [c.strip().split(" ")[0] for c in schema.split(",")]
        self.key = key or self.names[0]

    def _versions(self) -> list[int]:
        return sorted(int(n) for n in bronze.children(self.spark, f"{self.path}/log") if n.isdigit())

    def _entry(self, version: int) -> tuple[str, str]:
        kind, folder = bronze.read_text(self.spark, f"{self.path}/log/{version:012d}").split(" ", 1)
        return kind, folder

    def version(self) -> int:
        """The newest version; -1 before the first."""
        return max(self._versions(), default=-1)

    def _recent(self) -> tuple[int, list[str], str | None]:
        """(newest version, folders of its deltas, newest first, folder of the snapshot below them)."""
        have, deltas = self._versions(), []
        for v in reversed(have):
            kind, folder = self._entry(v)
            if kind == "snapshot":
                return have[-1], deltas, folder
            deltas.append(folder)
        return (have[-1] if have else -1), deltas, None

    def snapshot(self) -> tuple[int, DataFrame]:
        """(version, rows) of the newest version."""
        version, deltas, base = self._recent()
        rows = self.spark.read.schema(self.schema).parquet(base) if base else self.spark.createDataFrame([], self.schema)
        if deltas:
            rows = rows.withColumn(GONE, F.lit(False)).withColumn("__v", F.lit(0))
            for age, folder in enumerate(reversed(deltas), 1):
                changed = self.spark.read.schema(f"{self.schema}, {GONE} boolean").parquet(folder)
                rows = rows.unionByName(changed.withColumn("__v", F.lit(age)))
            rows = latest_by(rows, [self.key], [desc("__v")]).where(~F.col(GONE)).select(*self.names)
        return version, rows

    def read(self) -> DataFrame:
        return self.snapshot()[1]

    def commit(self, version: int, rows: DataFrame, changes: bool = True) -> int:
        """Make the version after ``version``, of changed rows (with a column __gone where some go) or of all rows. Raises Conflict if there is one."""
        return self._publish(version, "delta" if changes else "snapshot", self._stored(rows, changes))

    def _stored(self, rows: DataFrame, changes: bool) -> str:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        if changes:
            gone = F.col(GONE) if GONE in rows.columns else F.lit(False)
            rows = latest_by(rows.select(*self.names, gone.alias(GONE)), [self.key], [desc(n) for n in self.names[1:]])
        else:
            rows = rows.select(*self.names)
        rows.write.parquet(folder)
        return folder

    def _publish(self, version: int, kind: str, folder: str) -> int:
        # the newest is looked at too, for a version so old that its successor has been cleaned away is free again
        if self.version() != version or not bronze.create_new(self.spark, f"{self.path}/log/{version + 1:012d}", f"{kind} {folder}"):
            raise Conflict(f"{self.path} has changed since version {version}")
        if kind == "snapshot":
            self._clean()
        return version + 1

    def write(self, df: DataFrame) -> DataFrame:
        """Replace all rows, whatever they are by now, and give back what was stored."""
        folder = self._stored(df, False)
        for _ in range(TRIES):
            try:
                self._publish(self.version(), "snapshot", folder)
                return self.spark.read.schema(self.schema).parquet(folder)
            except Conflict:
                continue
        raise Conflict(f"{self.path} never stood still")

    def update(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """Apply ``change``, from the rows as they are to the rows that change (with __gone for those that go). It is computed anew if somebody was faster."""
        for _ in range(TRIES):
            version, rows = self.snapshot()
            folder = self._stored(change(rows), True)
            try:
                self._publish(version, "delta", folder)
                break
            except Conflict:
                bronze.remove(self.spark, folder)
        else:
            raise Conflict(f"{self.path} never stood still")
        self._compact()

    def _compact(self) -> None:
        if len(self._recent()[1]) >= COMPACT:
            try:
                version, rows = self.snapshot()
                self.commit(version, rows, changes=False)
            except Conflict:  # whoever was faster will do it
                pass

    def _clean(self) -> None:
        entries = [(v, *self._entry(v)) for v in self._versions()]
        whole = [v for v, kind, _ in entries if kind == "snapshot"]
        for v, _, folder in entries:
            if len(whole) >= KEEP_VERSIONS and v < whole[-KEEP_VERSIONS]:
                bronze.remove(self.spark, f"{self.path}/log/{v:012d}")
                bronze.remove(self.spark, folder)
