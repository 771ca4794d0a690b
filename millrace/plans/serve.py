"""Read-only serving: marts by name, and the headline figures that a dashboard derives from them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.dialect import ratio
from millrace.sources import bronze
from millrace.sources.keyed import file_system

#: Labels of weekdays (1 is Monday) and channels.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
CHANNEL_LABELS = {"facebook_paid_ads": "Facebook", "youtube_paid_ads": "YouTube", "tiktok_paid_ads": "TikTok", "other": "Other / organic"}


def pick(df: DataFrame, where: str | Column | None = None, order_by: list[str | Column] | str | Column | None = None, limit: int | None = None) -> DataFrame:
    """Rows of a served table: filtered, ordered with nulls last ("column DESC" for descending), limited."""
    if where is not None:
        df = df.where(where)
    if order_by is not None:
        keys = order_by if isinstance(order_by, list) else [order_by]
        df = df.orderBy(*[F.expr(k.rsplit(" ", 1)[0]).desc_nulls_last() if isinstance(k, str) and k.upper().endswith(" DESC") else F.expr(k).asc_nulls_last() if isinstance(k, str) else k for k in keys])
    return df if limit is None else df.limit(limit)


def gold(spark: SparkSession, mart: str, where=None, order_by=None, limit: int | None = None) -> DataFrame:
    return pick(spark.table(f"gold.{mart}"), where, order_by, limit)


def silver(spark: SparkSession, table: str, where=None, order_by=None, limit: int | None = None) -> DataFrame:
    return pick(spark.table(f"silver.{table}"), where, order_by, limit)


@dataclass
class _Kept:
    df: DataFrame
    path: str
    at: float


class Results:
    """Results of served queries, kept for ``seconds`` as files in ``folder`` and read in pages of ``page_rows`` rows.

    A query is known again by its plan, which names the tables of the build that its views show: an equal query runs no job while its result is
    kept, and a new build's views make another plan, so it is seen at once. The driver holds one page at a time."""

    def __init__(self, spark: SparkSession, folder: str, seconds: float = 600.0, page_rows: int = 1000, clock: Callable[[], float] = time.monotonic):
        self.spark, self.folder, self.seconds, self.page_rows, self.clock = spark, folder, seconds, page_rows, clock
        self.kept: dict[int, list[_Kept]] = {}

    def _path(self, df: DataFrame) -> str:
        self.forget()
        alike = self.kept.setdefault(df.semanticHash(), [])
        for k in alike:
            if k.df.sameSemantics(df):
                return k.path
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        alike.append(_Kept(df, path, self.clock()))
        return path

    def forget(self) -> None:
        """Drop results that have been kept long enough."""
        now = self.clock()
        for key, alike in list(self.kept.items()):
            for k in [k for k in alike if now - k.at >= self.seconds]:
                alike.remove(k)
                bronze.remove(self.spark, k.path)
            if not alike:
                del self.kept[key]

    def pages(self, df: DataFrame) -> Iterator[pa.Table]:
        """The result in order, each page but the last full; no page for no rows."""
        import pyarrow.parquet as pq

        system, path = file_system(self._path(df))
        rest: list[pa.RecordBatch] = []
        files = sorted(name for name in bronze.children(self.spark, path) if name.endswith(".parquet"))
        for name in files:
            with system.open_input_file(f"{path}/{name}") as f:
                for batch in pq.ParquetFile(f).iter_batches(self.page_rows):
                    rest.append(batch)
                    while (have := sum(map(len, rest))) >= self.page_rows:
                        whole = pa.Table.from_batches(rest)
                        yield whole.slice(0, self.page_rows)
                        rest = whole.slice(self.page_rows).to_batches() if have > self.page_rows else []
        if rest:
            yield pa.Table.from_batches(rest)


def channel_label(c: str | Column) -> Column:
    """The display name of a channel; unknown ones as they are."""
    col = F.col(c) if isinstance(c, str) else c
    out = F
    for name, label in CHANNEL_LABELS.items():
        out = out.when(col == name, label)
    return out.otherwise(col)


def weekday_label(c: str | Column) -> Column:
    return F.get(F.array(*map(F.lit, WEEKDAYS)), (F.col(c) if isinstance(c, str) else c).cast("int") - 1)


def overview(attribution: DataFrame) -> DataFrame:
    """Totals, blended cost per booking (summed, then divided once) and spend coverage over the channels that have spend."""
    paid = F.col("total_spend").isNotNull()
    return attribution.agg(
        F.sum("total_bookings").alias("bookings"), F.coalesce(F.sum("total_spend"), F.lit(0.0)).alias("spend"),
        F.sum(F.when(paid, F.col("days_observed") - F.col("days_spend_missing"))).alias("covered"), F.sum(F.when(paid, F.col("days_observed"))).alias("observed"),
    ).select("bookings", "spend", ratio("spend", "bookings").alias("blended_cpb"), ratio("covered", "observed").alias("spend_coverage"))


def play_rates(engagement: DataFrame) -> DataFrame:
    """Play rate of each medium, and of all together under a null name."""
    one = engagement.groupBy("media_name").agg(F.sum("load_count").alias("loads"), F.sum("play_count").alias("plays"))
    both = one.unionByName(one.agg(F.lit(None).cast("string").alias("media_name"), F.sum("loads").alias("loads"), F.sum("plays").alias("plays")))
    return both.withColumn("play_rate", ratio("plays", "loads"))


def funnel_by_channel(funnel: DataFrame) -> DataFrame:
    sums = funnel.groupBy("channel").agg(*[F.sum(c).alias(c) for c in ("bookings", "bookings_with_email", "bookings_with_prior_video")])
    return sums.withColumn("channel_label", channel_label("channel")).withColumn("email_coverage", ratio("bookings_with_email", "bookings"))


def heatmap(slots: DataFrame, perspective: str) -> DataFrame:
    """Bookings by hour and weekday in one perspective."""
    by = slots.where(F.col("perspective") == perspective).groupBy("hour_of_day", "day_of_week").agg(F.sum("bookings").alias("bookings"))
    return by.withColumn("dow_label", weekday_label("day_of_week"))


def latest(df: DataFrame, by: str) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last()).limit(1)
