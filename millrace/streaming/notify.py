"""Sinks for notices: a web hook that takes {"text": ...}, or a dry run where none is configured."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from millrace.session import ship_package

TIMEOUT = 10
RESULT = "event_id string, ok boolean, error string"


def post(url: str | None, text: str) -> str:
    """Post one text and say how: "sent", or "dry run" without a url. Any failure raises."""
    if not url:
        return "dry run"
    request = urllib.request.Request(url, data=json.dumps({"text": text}).encode(), headers={"Content-Type": "application/json"}, method="POST")
    with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:
        if not 200 <= answer.status < 300:
            raise urllib.error.HTTPError(url, answer.status, "not accepted", answer.headers, None)
    return "sent"


def sender(url: str | None) -> Callable[[DataFrame], DataFrame]:
    """A ``send`` for alerts.announce: executors post, one failure doesn't keep the others from being sent."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for event, text in zip(frame["event_id"], frame["text"]):
                try:
                    said = post(url, text)
                    rows.append((event, True, None if said == "sent" else said))
                except (OSError, ValueError) as fault:
                    rows.append((event, False, str(fault)[:500]))
            yield pd.DataFrame(rows, columns=["event_id", "ok", "error"])

    def send(notices: DataFrame) -> DataFrame:
        ship_package(notices.sparkSession)
        return notices.select("event_id", "text").mapInPandas(each, RESULT)

    return send


def escalator(url: str | None, say: Callable[[str], None] = print) -> Callable[[DataFrame], None]:
    """A ``notify`` for alerts.run_sweep: posts its one row, or says it in a dry run; a failure raises, and the sweep's outcome isn't stored."""

    def notify(rows: DataFrame) -> None:
        for row in rows.limit(1).collect():
            if post(url, row["text"]) == "dry run":
                say(row["text"])

    return notify
