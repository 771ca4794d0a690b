"""Layered build: every table of a layer is computed into its own versioned location, several at once and each within a limit of time; views are swapped
only if none failed, and all or none of them: what is to be swapped is written down first, so that a swap that stops half-way is undone, or
finished by whoever comes next."""

from __future__ import annotations

import json
import re
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.dialect import json_fields
from millrace.operators import gold, silver
from millrace.operators.silver import BuildContext
from millrace.sources import bronze, landing
from millrace.streaming import alerts

KEEP_BUILDS = 3
#: Seconds that a table may take, and tables built at once.
TABLE_SECONDS, AT_ONCE = 300.0, 4
#: Builders that read a table of the same build, and which.
SAME_BUILD = {"dq_lead_coverage": ("dim_lead",), "channel_attribution": ("cpb_by_channel",)}


class BuildFailed(RuntimeError):
    """Names the tables that failed; no view of their layer was swapped and no later layer was built."""


@dataclass
class BuildSummary:
    build_id: str
    asof: str
    built: dict[str, list[str]] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    swapped: list[str] = field(default_factory=list)
    pruned: list[str] = field(default_factory=list)


def new_build_id(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dt%H%M%S")


def funnel_field(bronze_tables: dict[str, DataFrame]) -> str:
    """The CRM key of the funnel field, from the seed."""
    seed = json_fields(bronze_tables["seed_custom_field_map"], {"field_id": ("field_id",), "field_name": ("field_name",)})
    row = seed.where("field_name = 'funnel' and field_id is not null").orderBy("field_id").first()
    if row is None:
        raise LookupError("the custom-field seed names no field 'funnel'")
    return row["field_id"]


def ordered(builders: dict[str, Callable]) -> list[str]:
    """Names so that whoever reads a table of the same build comes after it."""
    if not builders:
        raise ValueError("a layer without builders")
    done: list[str] = []
    while len(done) < len(builders):
        ready = [n for n in builders if n not in done and all(d in done for d in SAME_BUILD.get(n, ()))]
        if not ready:
            raise ValueError("builders wait for each other")
        done += ready
    return done


def write_version(df: DataFrame, database: str, table: str, build_id: str, root: str) -> str:
    """An immutable Parquet table of its own; writing the same build twice is an error."""
    name = f"{database}.{table}__{build_id}"
    df.write.format("parquet").mode("errorifexists").option("compression", "snappy").option("path", f"{root}/{database}/{table}/build={build_id}").saveAsTable(name)
    return name


def swap_view(spark: SparkSession, database: str, table: str, build_id: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} TBLPROPERTIES ('build' = '{build_id}') AS SELECT * FROM {database}.{table}__{build_id}")


def current_build(spark: SparkSession, database: str, table: str) -> str | None:
    """The build that a view shows; None if there is no such view."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return None
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.{table}").collect()}
    return known.get("build")


def _journal(warehouse_root: str, database: str) -> str:
    return f"{warehouse_root}/_publishing/{database}"


def publish(spark: SparkSession, warehouse_root: str, database: str, names: list[str], build_id: str) -> None:
    """Swap the views of a layer, all or none. If one can't be swapped, those that were go back to what they showed. Should even that fail, or the
    process die, the journal stays, and ``recover`` finishes the swap."""
    entry = {"build": build_id, "before": {n: current_build(spark, database, n) for n in names}}
    path = _journal(warehouse_root, database)
    if not bronze.create_new(spark, path, json.dumps(entry)):
        raise BuildFailed(f"another build is publishing {database}, or stopped while it did: recover first")
    done: list[str] = []
    try:
        for name in names:
            done.append(name)
            swap_view(spark, database, name, build_id)
    except Exception:
        _restore(spark, database, {n: entry["before"][n] for n in done})
        bronze.remove(spark, path)
        raise
    bronze.remove(spark, path)


def _restore(spark: SparkSession, database: str, before: dict[str, str | None]) -> None:
    for name, build_id in before.items():
        if build_id is None:
            spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
        else:
            swap_view(spark, database, name, build_id)


def recover(spark: SparkSession, warehouse_root: str) -> list[str]:
    """Finish swaps that stopped half-way: forward if all their tables are there, else back. Gives the layers that it touched."""
    touched = []
    for database in bronze.LAYERS:
        path = _journal(warehouse_root, database)
        if not bronze.exists(spark, path):
            continue
        entry = json.loads(bronze.read_text(spark, path))
        if all(spark.catalog.tableExists(f"{database}.{n}__{entry['build']}") for n in entry["before"]):
            for name in entry["before"]:
                swap_view(spark, database, name, entry["build"])
        else:
            _restore(spark, database, entry["before"])
        bronze.remove(spark, path)
        touched.append(database)
    return touched


def versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """Versioned tables, newest first. The pattern needs both underscores, or fct_booking would take in fct_booking_host."""
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__*'").collect()]
    return sorted((n for n in names if re.fullmatch(rf"{table}__[^_]+", n)), reverse=True)


def prune(spark: SparkSession, database: str, table: str, keep: int = KEEP_BUILDS) -> list[str]:
    """Drop the metadata of all but the newest ``keep`` versions; external data stays."""
    old = versions(spark, database, table)[keep:]
    for name in old:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    return old


def owner_snapshot(spark: SparkSession, state_root: str, bronze_root: str) -> Callable[[str], None]:
    """A ``before`` for build: exports the owner cache and the worklist of the alert stream to Bronze, as of the build's date; a failure aborts the build."""

    def export(asof: str) -> None:
        for state, feed in ((alerts.owners_of, "lead_owner"), (alerts.worklist_of, "awaiting_owner")):
            bronze.land(landing.export_snapshot(state(spark, state_root).read(), asof), bronze_root, feed)

    return export


class _Task:
    """One table, built in a thread of its own under a tag of its own."""

    def __init__(self, spark: SparkSession, name: str, tag: str, work: Callable[[], DataFrame]):
        self.spark, self.name, self.tag, self.work = spark, name, tag, work
        self.made: DataFrame | None = None
        self.fault: str | None = None
        self.began = time.monotonic()
        self.thread = threading.Thread(target=self._run, name=tag, daemon=True)
        self.thread.start()

    def _run(self) -> None:
        try:
            self.spark.sparkContext.addJobTag(self.tag)  # of this thread's jobs only; a tag of the session could be interrupted by this thread alone
            self.spark.sparkContext.setLocalProperty("spark.job.interruptOnCancel", "true")
            self.made = self.work()
        except Exception as e:
            self.fault = str(e).splitlines()[0][:500] if str(e) else type(e).__name__

    def stop(self, seconds: float, grace: float = 15.0) -> None:
        """Cancel its jobs, also those that it starts while they are being cancelled; whatever it still makes is not used."""
        end = time.monotonic() + grace
        while self.thread.is_alive() and time.monotonic() < end:
            self.spark.sparkContext.cancelJobsWithTag(self.tag)
            self.thread.join(0.5)
        self.fault = f"took longer than {seconds:g} s and was cancelled"


def build_layer(spark: SparkSession, layer: str, builders: dict[str, Callable], make: Callable[[str, dict[str, DataFrame]], DataFrame], build_id: str, seconds: float = TABLE_SECONDS, at_once: int = AT_ONCE) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(tables made, faults by name). All are attempted, up to ``at_once`` together, whoever reads a table of the same build after it; one that takes longer than
    ``seconds`` is cancelled and has failed. A table whose source failed fails with it."""
    todo, running, made, failed = ordered(builders), [], {}, {}
    while todo or running:
        for name in list(todo):
            needs = SAME_BUILD.get(name, ())
            if lost := [n for n in needs if n in failed]:
                failed[name] = f"needs {', '.join(lost)}, which failed"
                todo.remove(name)
            elif len(running) < at_once and all(n in made for n in needs):
                todo.remove(name)
                running.append(_Task(spark, name, f"{layer}.{name}.{build_id}", lambda n=name: make(n, made)))
        for task in list(running):
            task.thread.join(0.02)
            if task.thread.is_alive() and time.monotonic() - task.began > seconds:
                task.stop(seconds)
            elif task.thread.is_alive():
                continue
            running.remove(task)
            if task.fault is None:
                made[task.name] = task.made
            else:
                failed[task.name] = task.fault
    return {n: made[n] for n in builders if n in made}, failed


def build(
    spark: SparkSession, bronze_root: str, warehouse_root: str, asof: str, build_id: str | None = None, before: Callable[[str], None] | None = None, keep: int = KEEP_BUILDS, layers: dict[str, dict[str, Callable]] | None = None,
    seconds: float = TABLE_SECONDS, at_once: int = AT_ONCE,
) -> BuildSummary:
    """Snapshot the operational state (``before``), then Silver, then Gold. All tables of a layer are attempted, each within ``seconds``; if any
    failed, its views stay, later layers aren't built, and BuildFailed names them."""
    out = BuildSummary(build_id or new_build_id(), asof)
    bronze.create_databases(spark)
    recover(spark, warehouse_root)
    if before is not None:
        before(asof)
    tables = bronze.read_all(spark, bronze_root)
    ctx = BuildContext(out.build_id, asof, funnel_field(tables))
    for layer, builders in (layers or {"silver": silver.BUILDERS, "gold": gold.BUILDERS}).items():

        def make(name: str, made: dict[str, DataFrame], layer=layer, builders=builders, tables=tables) -> DataFrame:
            df = builders[name](ctx, tables, *(made[d] for d in SAME_BUILD.get(name, ())))
            return spark.table(write_version(df, layer, name, out.build_id, warehouse_root))

        made, failed = build_layer(spark, layer, builders, make, out.build_id, seconds, at_once)
        out.built[layer] = list(made)
        if failed:
            out.failed = {f"{layer}.{n}": fault for n, fault in failed.items()}
            raise BuildFailed(f"build {out.build_id}: {layer} failed: {', '.join(out.failed)}; views unchanged: {out.failed}")
        publish(spark, warehouse_root, layer, list(made), out.build_id)
        out.swapped += [f"{layer}.{name}" for name in made]
        for name in made:
            out.pruned += [f"{layer}.{n}" for n in prune(spark, layer, name, keep)]
        tables = made
    return out


def preview(ctx: BuildContext, bronze_tables: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """All 18 tables as lazy DataFrames, nothing written."""
    layers = []
    tables = bronze_tables
    for builders in (silver.BUILDERS, gold.BUILDERS):
        made: dict[str, DataFrame] = {}
        for name in ordered(builders):
            made[name] = builders[name](ctx, tables, *(made[d] for d in SAME_BUILD.get(name, ())))
        layers.append(made)
        tables = made
    return layers[0], layers[1]
