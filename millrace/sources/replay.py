"""A replay of made-up CRM events as a stream that delivers each of them several times at once, as a retrying sender would."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.session import ship_package

START = datetime(2025, 5, 20, 12)


def body(k: int, leads: int) -> str:
    """The k-th event: created, or every third time updated."""
    at = (START + timedelta(seconds=k)).isoformat(timespec="microseconds")
    lead, updated = f"lead_{k % max(1, leads):06d}", k % 3 == 2
    data = {"id": lead, "display_name": f"Test Lead {k}", "status_label": "Potential", "date_created": f"{at}+00:00", "date_updated": f"{at}+00:00"}
    event = {"id": f"ev_{k:08d}", "date_created": at, "date_updated": at, "object_type": "lead", "object_id": lead, "lead_id": lead}
    event |= {"action": "updated" if updated else "created", "changed_fields": ["status_label"] if updated else [], "data": data}
    return json.dumps({"subscription_id": "whsub_test", "event": event})


class Replay(DataSource):
    """Options: count (of events), repeat (deliveries of each), partitions (readers at once), per_batch (events of a batch)."""

    @classmethod
    def name(cls) -> str:
        return "crm_replay"

    def schema(self) -> str:
        return "body string, delivery int"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(*(int(self.options.get(n, d)) for n, d in (("count", 100), ("repeat", 1), ("partitions", 4), ("per_batch", 1000))))


class _Part(InputPartition):
    """Deliveries number lo to hi, of which each ``step``-th is this reader's."""

    def __init__(self, lo: int, hi: int, at: int, step: int):
        self.lo, self.hi, self.at, self.step = lo, hi, at, step


class _Reader(DataSourceStreamReader):
    """An offset is how many events have been delivered. Deliveries of one event go to different readers. A query that is started again is delivered
    everything anew, as by a sender that has forgotten."""

    def __init__(self, count: int, repeat: int, partitions: int, per_batch: int):
        self.count, self.repeat, self.readers, self.per_batch = count, max(1, repeat), partitions, per_batch
        self.now = 0

    def initialOffset(self) -> dict:
        return {"events": 0}

    def latestOffset(self) -> dict:
        self.now = min(self.count, self.now + self.per_batch)
        return {"events": self.now}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Part(start["events"], end["events"], k, self.readers) for k in range(self.readers)]

    def read(self, partition: _Part) -> Iterator[tuple[str, int]]:
        for n in range(partition.lo * self.repeat + partition.at, partition.hi * self.repeat, partition.step):
            yield body(n // self.repeat, self.count // 2), n % self.repeat + 1

    def commit(self, end: dict) -> None:
        self.now = max(self.now, end["events"])


def stream(spark: SparkSession, count: int, repeat: int = 1, partitions: int = 4, per_batch: int = 1000) -> DataFrame:
    """body and delivery of ``count`` events, each delivered ``repeat`` times."""
    ship_package(spark)
    spark.dataSource.register(Replay)
    return spark.readStream.format("crm_replay").options(count=count, repeat=repeat, partitions=partitions, per_batch=per_batch).load()
