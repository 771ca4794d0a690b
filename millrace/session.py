"""Session factory with the settings that the engine's semantics rest on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: Zone-less timestamps mean UTC everywhere, partition values stay strings, AQE re-plans joins and skew at run time, and checkpoints go when out of use.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | None = None, app: str = "millrace", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass SEMANTICS to the submit command instead."""
    n = cores or os.cpu_count() or 4
    conf = SEMANTICS | {
        "spark.sql.shuffle.partitions": str(n),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | extra
    spark = SparkSession.builder.master(f"local[{n}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_semantics(spark: SparkSession) -> SparkSession:
    """Set the runtime-settable part of SEMANTICS on a session made elsewhere."""
    for key, value in SEMANTICS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each context, unless they were given it (it runs from an archive then)."""
    sc = spark.sparkContext
    home = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_millrace_shipped", False) or not os.path.isdir(home):
        return
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="millrace-package-")), "millrace.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("millrace", os.path.relpath(full, home)))
    sc.addPyFile(path)
    sc._millrace_shipped = True
