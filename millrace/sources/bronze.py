"""Bronze: immutable newline-delimited JSON, one string column ``raw``, Hive-style date partitions kept as strings."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class BronzeTable:
    prefix: str
    partition: str | None
    grain: str


#: Where each feed lands and what partitions it.
CATALOG = {
    "crm_event": BronzeTable("crm/events", "dt", "event id"),
    "calendly_booking": BronzeTable("calendly/bookings", "dt", "invitee uri"),
    "calendly_cancellation": BronzeTable("calendly/cancellations", "dt", "invitee uri"),
    "calendly_spend": BronzeTable("calendly/spend", "asof", "date and channel, in many files"),
    "wistia_media": BronzeTable("wistia/media", "asof", "hashed id, a snapshot a day"),
    "wistia_media_stats": BronzeTable("wistia/media_stats", "dt", "hashed id and date"),
    "wistia_visitor_event": BronzeTable("wistia/visitor_events", "dt", "event key"),
    "seed_channel_map": BronzeTable("seeds/channel_map", None, "event type"),
    "seed_custom_field_map": BronzeTable("seeds/custom_field_map", None, "field id"),
    "lead_owner": BronzeTable("crm/lead_owner", "asof", "lead id, a snapshot a day"),
    "awaiting_owner": BronzeTable("crm/awaiting_owner", "asof", "lead id, a snapshot a day"),
}
LAYERS = ("bronze", "silver", "gold")


def create_databases(spark: SparkSession) -> None:
    for name in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """raw, the partition column and source_path. A filter on the partition prunes directories; a feed that has never landed is empty."""
    t = CATALOG[name]
    path = f"{root}/{t.prefix}"
    fields = [T.StructField("value", T.StringType())] + ([T.StructField(t.partition, T.StringType())] if t.partition else [])
    if not (any(c.startswith(f"{t.partition}=") for c in children(spark, path)) if t.partition else exists(spark, path)):
        empty = spark.createDataFrame([], T.StructType([*fields, T.StructField("source_path", T.StringType())]))
        return empty.withColumnRenamed("value", "raw")
    df = spark.read.schema(T.StructType(fields)).text(path)
    return df.select(F.col("value").alias("raw"), *([t.partition] if t.partition else []), F.col("_metadata.file_path").alias("source_path")).where(F.length("raw") > 0)


def _path(spark: SparkSession, path: str):
    """A path and the file system it is on, as Spark itself sees them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _path(spark, path)
    return system.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    at, system = _path(spark, path)
    return [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    at, system = _path(spark, path)
    system.delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    at, system = _path(spark, path)
    system.mkdirs(at)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    at, system = _path(spark, path)
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file, whole, if there is none of that name; False if there is. Of two who try at once one gets False, on any file system whose
    rename is atomic; on the local one, whose isn't exclusive, a hard link is."""
    at, system = _path(spark, path)
    at = system.makeQualified(at)
    draft = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(text.encode())
    out.close()
    try:
        if at.toUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), at.toUri().getPath())
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
            context.rename(draft, at, spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0))
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(draft, False)


def read_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read(spark, root, name) for name in CATALOG}


def stream(spark: SparkSession, root: str, name: str, per_trigger: int = 1000) -> DataFrame:
    """The same feed as an unbounded stream of new files; _metadata tells when each landed."""
    t = CATALOG[name]
    fields = [T.StructField("value", T.StringType())] + ([T.StructField(t.partition, T.StringType())] if t.partition else [])
    df = spark.readStream.schema(T.StructType(fields)).option("maxFilesPerTrigger", per_trigger).format("text").load(f"{root}/{t.prefix}")
    return df.withColumnRenamed("value", "raw")


def land(rows: DataFrame, root: str, name: str, body: str | Column = "raw") -> None:
    """Write a feed's snapshot: lines under its prefix, replacing the partitions that are present in ``rows`` as a whole, so that a re-pull of a day is
    idempotent. Single events and objects with names of their own are written by landing.land_events and land_pulls."""
    t = CATALOG[name]
    line = (F.col(body) if isinstance(body, str) else body).alias("value")
    writer = rows.select(line, *([t.partition] if t.partition else [])).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(t.partition) if t.partition else writer).text(f"{root}/{t.prefix}")
