import http.server
import json
import threading
import time
import uuid

import pandas as pd
import pytest
from feeds import crm
from pyspark.sql import functions as F

from millrace.sources import bronze, replay
from millrace.streaming import alerts, notify


def test_claims(spark):
    ledger = spark.createDataFrame([("sent", "SENT", 0, 1), ("fresh", "PENDING", 950, None), ("stale", "PENDING", 800, None)], alerts.LEDGER)
    seen = spark.createDataFrame([(e, 1000) for e in ("new", "new", "sent", "fresh", "stale")], "event_id string, at long")
    assert {(r.event_id, r.deliveries) for r in alerts.claim(seen, ledger).collect()} == {("new", 2), ("stale", 1)}


def test_sweep(spark):
    work = spark.createDataFrame([("a", "e", 1, 0, "AWAITING", None), ("b", "e", 1, 23, "AWAITING", None), ("c", "e", 1, 5, "AWAITING", None), ("d", "e", 1, 24, "EXHAUSTED", None), ("f", "e", 1, 2, "AWAITING", None)], alerts.AWAITING)
    swept = alerts.sweep(work, spark.createDataFrame([("a",), ("d",)], "lead_id string"), 100, failed=spark.createDataFrame([("f",)], "lead_id string"))
    assert {(r.lead_id, r.next_status, r.next_count) for r in swept.collect()} == {("a", "PROMOTED", 0), ("b", "EXHAUSTED", 24), ("c", "AWAITING", 6)}
    moved = work.withColumn("retry_count", F.when(F.col("lead_id") == "c", 6).otherwise(F.col("retry_count")))  # another sweep was faster
    after = {r.lead_id: (r.status, r.retry_count) for r in alerts.apply_sweep(moved, swept).collect()}
    assert after == {"b": ("EXHAUSTED", 24), "c": ("AWAITING", 6), "d": ("EXHAUSTED", 24), "f": ("AWAITING", 2)}
    assert alerts.escalation(swept).first().text.endswith("`b`") and alerts.escalation(swept.where("false")).count() == 0
    many = spark.range(25).select(F.format_string("l%02d", "id").alias("lead_id"), F.lit("EXHAUSTED").alias("next_status"))
    assert alerts.escalation(many).first().text.endswith("…and 5 more")


def test_worklist_keeps_counters(spark):
    work = spark.createDataFrame([("a", "e1", 1, 7, "AWAITING", 3)], alerts.AWAITING)
    out = alerts.add_missing(work, spark.createDataFrame([("a", "e2"), ("b", "e4"), ("b", "e3")], "lead_id string, event_id string"), 9)
    assert {(r.lead_id, r.event_id, r.first_seen_at, r.retry_count) for r in out.collect()} == {("a", "e1", 1, 7), ("b", "e3", 9, 0)}


def acked(fail=()):
    """A send that fails for some events, and what it has sent."""
    sent = []

    def send(df):
        rows = df.collect()
        sent.extend((r.event_id, r.text) for r in rows if r.event_id not in fail)
        return df.sparkSession.createDataFrame([(r.event_id, r.event_id not in fail, None if r.event_id not in fail else "down") for r in rows], alerts.RESULTS)

    return send, sent


def wait(query, until, seconds=60):
    """Until the stream has come so far."""
    end = time.time() + seconds
    while not until():
        assert query.isActive, query.exception()
        assert time.time() < end, "the stream didn't come so far"
        time.sleep(0.2)


TICK = {"processingTime": "300 milliseconds"}


def test_stream_sends_once_and_keeps_misses(spark, land, tmp_path):
    """Redeliveries, in a batch and later, are sent once; a notice that failed is claimed again after the lease, without being delivered anew."""
    root = land("crm/events/dt=2025-05-20/a.json", [crm("ev_1"), crm("ev_1"), crm("ev_2", lead="lead_2", name=""), {"event": {"id": "no lead"}}, "not json"])
    fail = {"ev_2"}
    send, sent = acked(fail)
    owners = spark.createDataFrame([("lead_1", json.dumps({"lead_owner": "Bob", "lead_email": "a@x", "funnel": ""}))], "lead_id string, raw string")
    state = str(tmp_path / "state")
    q = alerts.run(spark, root, state, lambda leads: owners, send, delay=0, lease=4, **TICK)
    try:
        wait(q, lambda: len(sent) == 1)
        assert sent[0][0] == "ev_1" and "*Lead Owner:* Bob" in sent[0][1] and "*Funnel:* _pending_" in sent[0][1]
        fail.clear()
        wait(q, lambda: len(sent) == 2)
        assert sent[1][0] == "ev_2" and "_not provided_" in sent[1][1] and "_pending assignment_" in sent[1][1]
        land("crm/events/dt=2025-05-20/b.json", [crm("ev_1"), crm("ev_2", lead="lead_2", name=""), crm("ev_3")])
        wait(q, lambda: len(sent) == 3)
        time.sleep(6)  # another lease
    finally:
        q.stop()
    assert [s[0] for s in sent] == ["ev_1", "ev_2", "ev_3"]
    assert [(r.lead_id, r.retry_count) for r in alerts.worklist_of(spark, state).read().collect()] == [("lead_2", 0)]
    assert [(r.lead_id, r.lead_owner) for r in alerts.owners_of(spark, state).read().collect()] == [("lead_1", "Bob")]


def test_events_wait_for_the_delay(spark, land, tmp_path):
    root = land("crm/events/dt=2025-05-20/a.json", [crm("ev_1")])
    landed = (tmp_path / "bronze/crm/events/dt=2025-05-20/a.json").stat().st_mtime
    at = []
    none = spark.createDataFrame([], "lead_id string, raw string")
    send, sent = acked()
    q = alerts.run(spark, root, str(tmp_path / "s"), lambda leads: none, lambda df: (at.append(time.time()), send(df))[1], delay=12, lease=60, **TICK)
    try:
        wait(q, lambda: sent)
    finally:
        q.stop()
    assert [s[0] for s in sent] == ["ev_1"] and at[0] >= int(landed) + 12


def test_given_up_after_some_claims(spark, land, tmp_path):
    root = land("crm/events/dt=2025-05-20/a.json", [crm("bad"), crm("good")])
    send, sent = acked({"bad"})
    tried = []
    none = spark.createDataFrame([], "lead_id string, raw string")
    state = str(tmp_path / "s")
    q = alerts.run(spark, root, state, lambda leads: none, lambda df: (tried.extend(r.event_id for r in df.collect()), send(df))[1], delay=0, lease=1, most=2, **TICK)
    try:
        wait(q, lambda: bronze.exists(spark, f"{state}/dead"))
        time.sleep(3)
    finally:
        q.stop()
    assert sorted(tried) == ["bad", "bad", "good"] and [s[0] for s in sent] == ["good"]
    dead = spark.read.option("recursiveFileLookup", True).schema(alerts.DUE).parquet(f"{state}/dead").collect()
    assert [(r.event_id, r.attempts, json.loads(r.raw)["event"]["id"]) for r in dead] == [("bad", 2, "bad")]


@pytest.mark.parametrize("where", ["lookup", "send", "acknowledge"])
def test_a_batch_that_dies_loses_nothing(spark, land, tmp_path, monkeypatch, where):
    """The batch in which an event falls due dies before or after it was sent; the query is started again: it is sent, twice only if it had been."""
    root = land("crm/events/dt=2025-05-20/a.json", [crm("ev_1")])
    state, broken = str(tmp_path / "s"), [True]
    send, sent = acked()

    def fails(df, then):
        if broken[0]:
            raise OSError(where)
        return then(df)

    none = spark.createDataFrame([], "lead_id string, raw string")
    owners = (lambda leads: fails(leads, lambda _: none)) if where == "lookup" else lambda leads: none
    sends = (lambda df: fails(df, send)) if where == "send" else send
    written = alerts._written
    if where == "acknowledge":  # the answers of the sink are never stored

        def crash(df, path):
            return fails(written(df, path), lambda x: x) if "/results/" in path else written(df, path)

        monkeypatch.setattr(alerts, "_written", crash)
    go = lambda: alerts.run(spark, root, state, owners, sends, delay=3, lease=60, **TICK)
    q = go()
    with pytest.raises(Exception, match=where):
        q.awaitTermination(60)
    assert len(sent) == (where == "acknowledge")
    broken[0] = False
    q = go()
    try:
        wait(q, lambda: len(sent) == 1 + (where == "acknowledge"))
        time.sleep(2)
    finally:
        q.stop()
    assert [s[0] for s in sent] == ["ev_1"] * (1 + (where == "acknowledge"))
    assert [r.lead_id for r in alerts.worklist_of(spark, state).read().collect()] == ["lead_1"]


def test_replay_that_delivers_at_once_sends_once(spark, tmp_path):
    """Every event of a replay is delivered three times at once by several readers, and each is sent once."""
    events = replay.stream(spark, 40, repeat=3, partitions=3, per_batch=8).select(F.col("body").alias("raw"), F.lit(0).cast("long").alias("landed_at"))
    send, sent = acked()
    none = spark.createDataFrame([], "lead_id string, raw string")
    q = alerts.run(spark, "", str(tmp_path / "s"), lambda leads: none, send, delay=0, lease=60, events=events, **TICK)
    try:
        wait(q, lambda: len(sent) >= 40, 90)
        time.sleep(2)
    finally:
        q.stop()
    assert sorted(s[0] for s in sent) == [f"ev_{k:08d}" for k in range(40)]


def test_run_sweep(spark, tmp_path):
    state = str(tmp_path / "s")
    work = spark.createDataFrame([(x, "e", 1, n, "AWAITING", None) for x, n in (("a", 0), ("b", 23), ("c", 1), ("d", 2))], alerts.AWAITING)
    alerts.StateTable(spark, f"{state}/awaiting", alerts.AWAITING).write(work)
    answers = spark.createDataFrame([("a", '{"lead_owner": "Bob"}', False), ("b", None, False), ("c", None, False), ("d", None, True)], "lead_id string, raw string, failed boolean")
    told = []
    out = alerts.run_sweep(spark, state, lambda leads: answers.join(leads, "lead_id", "left_semi"), lambda df: told.extend(df.collect()), now=50)
    assert out == {"promoted": 1, "still_waiting": 1, "exhausted": 1, "source_errors": 1} and len(told) == 1
    rows = {r.lead_id: (r.status, r.retry_count) for r in alerts.StateTable(spark, f"{state}/awaiting", alerts.AWAITING).read().collect()}
    assert rows == {"b": ("EXHAUSTED", 24), "c": ("AWAITING", 2), "d": ("AWAITING", 2)}
    assert [(r.lead_id, r.lead_owner) for r in alerts.StateTable(spark, f"{state}/owners", alerts.OWNERS).read().collect()] == [("a", "Bob")]
    assert bronze.children(spark, f"{state}/sweeps") == []


def test_lazy_calls_are_made_once(spark, tmp_path):
    """A send and a lookup that are plans, not collected rows: each event is posted once, each lead asked for once."""
    log = tmp_path / "calls"
    log.mkdir()

    def note(kind, key):
        (log / f"{kind}-{key}-{uuid.uuid4().hex}").touch()

    def send(df):
        def each(frames):
            for f in frames:
                for e in f.event_id:
                    note("post", e)
                yield pd.DataFrame({"event_id": f.event_id, "ok": True, "error": None})

        return df.mapInPandas(each, alerts.RESULTS)

    def owners(leads):
        def each(frames):
            for f in frames:
                for e in f.lead_id:
                    note("ask", e)
                yield pd.DataFrame({"lead_id": f.lead_id, "raw": '{"lead_owner": "Bob"}'})

        return leads.mapInPandas(each, "lead_id string, raw string")

    due = [(f"ev_{k}", json.dumps(crm(f"ev_{k}", lead=f"lead_{k}")), 1, "due") for k in range(3)]
    state = str(tmp_path / "s")
    alerts.announce(spark, spark.createDataFrame(due, alerts.DUE), state, owners, send, 0)
    alerts.announce(spark, spark.createDataFrame([], alerts.DUE), state, owners, send, 1)
    assert sorted(r.event_id for r in spark.read.schema("event_id string").json(f"{state}/acks/b0").collect()) == ["ev_0", "ev_1", "ev_2"]
    calls = sorted(p.name.rsplit("-", 1)[0] for p in log.iterdir())
    assert calls == sorted([f"post-ev_{k}" for k in range(3)] + [f"ask-lead_{k}" for k in range(3)])


def test_stream_and_sweep_interleave(spark, tmp_path):
    """What the stream adds while a sweep is out looking stays, and a count that another sweep raised isn't raised twice."""
    state = str(tmp_path / "s")
    waiting = alerts.StateTable(spark, f"{state}/awaiting", alerts.AWAITING)
    waiting.write(spark.createDataFrame([("a", "e", 1, 3, "AWAITING", None), ("b", "e", 1, 3, "AWAITING", None)], alerts.AWAITING))

    def meanwhile(leads):
        now = waiting.read()
        waiting.write(alerts.add_missing(now, spark.createDataFrame([("new", "e9")], "lead_id string, event_id string"), 7).withColumn("retry_count", F.expr("if(lead_id = 'b', 4, retry_count)")))
        return leads.select("lead_id", F.lit(None).cast("string").alias("raw"))

    alerts.run_sweep(spark, state, meanwhile, lambda df: None, now=50)
    assert {(r.lead_id, r.retry_count) for r in waiting.read().collect()} == {("a", 4), ("b", 4), ("new", 0)}


def test_sweep_takes_turns(spark, tmp_path):
    state, asked = str(tmp_path / "s"), []
    rows = [(f"l{k}", "e", 1, 0, "AWAITING", None) for k in range(5)]
    alerts.StateTable(spark, f"{state}/awaiting", alerts.AWAITING).write(spark.createDataFrame(rows, alerts.AWAITING))
    none = lambda leads: (asked.append(sorted(r.lead_id for r in leads.collect())), leads.select("lead_id", F.lit(None).cast("string").alias("raw")))[1]
    for now in (10, 20, 30):
        alerts.run_sweep(spark, state, none, lambda df: None, now=now, limit=2)
    assert asked == [["l0", "l1"], ["l2", "l3"], ["l0", "l4"]]


def test_two_sweeps_at_once(spark, tmp_path):
    """Both look up the same rows, both store: each row is counted once, and each sweep's own promotions stay."""
    state, none = str(tmp_path / "s"), lambda leads: leads.select("lead_id", F.lit(None).cast("string").alias("raw"))
    waiting = alerts.worklist_of(spark, state)
    waiting.write(spark.createDataFrame([(f"l{k}", "e", 1, 0, "AWAITING", None) for k in range(4)], alerts.AWAITING))
    both = threading.Barrier(2, timeout=60)
    out = []

    def sweep():
        out.append(alerts.run_sweep(spark, state, lambda leads: (both.wait(), none(leads))[1], lambda df: None, now=9))

    many = [threading.Thread(target=sweep) for _ in range(2)]
    [t.start() for t in many]
    [t.join() for t in many]
    assert len(out) == 2 and {(r.lead_id, r.retry_count) for r in waiting.read().collect()} == {(f"l{k}", 1) for k in range(4)}


def test_notice_sinks(spark):
    got = []

    class Hook(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            text = json.loads(self.rfile.read(int(self.headers["Content-Length"])))["text"]
            got.append(text)
            self.send_response(500 if "bad" in text else 200)
            self.end_headers()

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Hook)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/"
    rows = spark.createDataFrame([("e1", "good"), ("e2", "bad"), ("e3", "fine")], "event_id string, text string")
    assert {(r.event_id, r.ok) for r in notify.sender(url)(rows).collect()} == {("e1", True), ("e2", False), ("e3", True)} and sorted(got) == ["bad", "fine", "good"]
    assert {(r.ok, r.error) for r in notify.sender(None)(rows).collect()} == {(True, "dry run")}
    said = []
    notify.escalator(None, said.append)(spark.createDataFrame([("text", 1)], "text string, n long"))
    assert said == ["text"]
    with pytest.raises(OSError):
        notify.escalator(url)(spark.createDataFrame([("bad", 1)], "text string, n long"))
    server.shutdown()
