"""A bounded window of a paged HTTP API as a Spark data source: one input partition for each medium and day (or each medium alone).

The contract: a page is asked for again after a rate limit, a server fault, a lost connection or a broken body, each time later; any other
refusal is final. A window ends with its first short page, and one that doesn't end within MAX_PAGES is an error, for a truncated
window must not look whole."""

from __future__ import annotations

import http.client
import itertools
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of the API: rows a page, pages a window, seconds a request, seconds waited before each further attempt.
PER_PAGE, MAX_PAGES, TIMEOUT = 100, 50, 30
WAITS = (2.0, 4.0, 8.0)
#: Answers that are worth asking again.
PASSING = frozenset({429, 500, 502, 503, 504})

Transport = Callable[[str, dict, str], tuple[int, bytes]]


class Refused(RuntimeError):
    """The API's answer is final."""


class Unavailable(RuntimeError):
    """Every attempt failed."""


def http_get(url: str, query: dict, token: str) -> tuple[int, bytes]:
    """Status and body; status 0 if there was no answer."""
    target = f"{url}?{urllib.parse.urlencode(query)}" if query else url
    headers = {"Authorization": f"Bearer {token}"} if token else {}
    try:
        with urllib.request.urlopen(urllib.request.Request(target, headers=headers), timeout=TIMEOUT) as answer:
            return answer.status, answer.read()
    except urllib.error.HTTPError as refusal:
        return refusal.code, refusal.read()
    except (OSError, http.client.HTTPException) as fault:  # no connection, a timeout, half an answer
        return 0, str(fault).encode()


def understood(status: int, body: bytes) -> tuple[bool, Any]:
    """(final?, value): a parsed body, or what is wrong with an answer that may be better next time. Raises Refused."""
    if status and status not in PASSING and not 200 <= status < 300:
        raise Refused(f"status {status}: {body[:200].decode(errors='replace')}")
    if status == 0 or status in PASSING:
        return False, f"status {status}: {body[:200].decode(errors='replace')}"
    try:
        return True, json.loads(body)
    except ValueError as fault:
        return False, f"not JSON: {fault}"


@dataclass(frozen=True)
class Client:
    """Asks a transport until an answer is final; the waits say how often and when."""

    url: str
    token: str = ""
    waits: Iterable[float] = WAITS
    transport: Transport = http_get
    sleep: Callable[[float], None] = time.sleep

    def ask(self, query: dict) -> Any:
        said: Any = None
        for wait in itertools.chain((0.0,), self.waits):
            if wait:
                self.sleep(wait)
            final, said = understood(*self.transport(self.url, query, self.token))
            if final:
                return said
        raise Unavailable(f"{self.url} {query}: {said}")

    def window(self, query: dict) -> Iterator[dict]:
        """The rows of a window. An answer that is one object is a window of one row."""
        pages = (self._page(query, 1 + n) for n in range(MAX_PAGES))
        last: list = []
        for last in pages:
            yield from last
            if len(last) < PER_PAGE:
                break
        if len(last) >= PER_PAGE:
            raise Unavailable(f"{self.url} {query}: more than {MAX_PAGES} pages; narrow the window")

    def _page(self, query: dict, number: int) -> list:
        answer = self.ask(query | {"page": number, "per_page": PER_PAGE})
        if isinstance(answer, dict):
            return [answer]
        if isinstance(answer, list):
            return answer
        raise Refused(f"{self.url} {query}: page {number} is neither a list nor an object")


class PagedEvents(DataSource):
    """Options: url ("{hashed_id}" in it is filled in), media and days (comma-separated; no days: one request a medium), token.

    Columns: hashed_id, dt (null without days), raw (JSON with sorted keys, so that an unchanged re-pull is the same bytes)."""

    @classmethod
    def name(cls) -> str:
        return "paged_events"

    def schema(self) -> str:
        return "hashed_id string, dt string, raw string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


@dataclass
class _Window(InputPartition):
    medium: str
    day: str | None


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        listed = lambda key: [x.strip() for x in options.get(key, "").split(",") if x.strip()]
        self.url, self.token = options["url"], options.get("token", "")
        self.media, self.days = listed("media"), listed("days") or [None]
        self.waits = tuple(float(x) for x in options["waits"].split(",")) if "waits" in options else WAITS

    def partitions(self):
        return [_Window(*w) for w in itertools.product(self.media, self.days)]

    def read(self, partition):
        client = Client(self.url.replace("{hashed_id}", urllib.parse.quote(partition.medium, safe="")), self.token, self.waits)
        query = {"start_date": partition.day, "end_date": partition.day} if partition.day else {}
        if "{hashed_id}" not in self.url:
            query["media_id"] = partition.medium
        for row in client.window(query):
            yield partition.medium, partition.day, json.dumps(row, separators=(",", ":"), sort_keys=True)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("paged_events")`` known. Workers need the package: see session.ship_package."""
    spark.dataSource.register(PagedEvents)
