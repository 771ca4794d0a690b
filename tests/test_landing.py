import hashlib
import hmac
import http.server
import json
import threading
import urllib.parse

import pytest
from feeds import booking, crm
from pyspark.sql import functions as F

from millrace.operators import silver
from millrace.sources import bronze, landing, paged, signature
from millrace.sources.state import StateTable


def bodies(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, str) or r is None else json.dumps(r),) for r in rows], "body string")


def test_crm_keys(spark):
    no_date = crm("ev_9")
    no_date["event"]["date_created"] = ""
    out = landing.crm_events(bodies(spark, crm("ev_1"), crm("ev_1"), {"event": {}}, no_date, "{broken", None))
    assert [r.status_code for r in out.collect()] == [200, 200, 400, 400, 400, 400]
    assert [r.key for r in landing.once(out).collect()] == ["crm/events/dt=2025-05-20/crm_event_ev_1.json"]


def test_booking_routes(spark):
    gone = booking("m", "i", event="invitee.canceled", updated="2025-07-11T09:30:00Z")
    out = landing.booking_events(bodies(spark, booking("m", "i"), gone, {"event": "other", "payload": {}}, {"event": "invitee.created", "payload": {}}, "nonsense")).collect()
    keys = ["calendly/bookings/dt=2025-07-09/calendly_event_i.json", "calendly/cancellations/dt=2025-07-11/calendly_cancel_i.json", None, None, None]
    assert [(r.status_code, r.key) for r in out] == list(zip([200, 200, 200, 400, 400], keys)) and out[2].feed is None


def test_bad_signatures_are_refused(spark):
    out = landing.with_signature(landing.crm_events(bodies(spark, crm("ev_1"), crm("ev_2"), "{broken")), F.col("body").contains("ev_1"))
    assert [(r.status_code, r.key is None) for r in out.collect()] == [(200, False), (401, True), (400, True)]


def test_spend_pull_converges(spark, tmp_path):
    src = tmp_path / "published"
    src.mkdir()
    put = lambda day, rows: (src / f"spend_data_{day}.json").write_text(json.dumps(rows, indent=1) if not isinstance(rows, str) else rows)
    row = lambda d, v: {"date": d, "channel": "tiktok_paid_ads", "spend": v}
    put("2026-07-21", [row("2026-07-20", 1.5), row("2026-07-21", 2)])
    put("2026-07-22", "{broken")
    empty = spark.createDataFrame([], "asof string, content_hash string, size_bytes long, pulled_at long, row_count long, date_min string, date_max string, distinct_dates long, channels string")
    files = lambda: landing.read_files(spark, str(src))
    lines, manifest = landing.spend_pull(files(), empty, 1)
    assert sorted(json.loads(r.raw)["spend"] for r in lines.collect()) == [1.5, 2]
    m = manifest.collect()
    assert [(r.asof, r.row_count, r.date_min, r.date_max, r.channels) for r in m] == [("2026-07-21", 2, "2026-07-20", "2026-07-21", "tiktok_paid_ads")]
    known = spark.createDataFrame(m, empty.schema)
    published = index(spark, {"files": ["x/spend_data_2026-07-21.json", "spend_data_2026-07-22.json", "README.txt"]})
    assert [r.asof for r in landing.still_missing(published, known).collect()] == ["2026-07-22"]
    put("2026-07-21", [row("2026-07-20", 9)])
    put("2026-07-22", [row("2026-07-22", 3)])
    state = {r.asof: r.state for r in landing.classify(files(), known).collect()}
    assert state == {"2026-07-21": "corrected", "2026-07-22": "new"}
    lines, manifest = landing.spend_pull(files(), known, 2)
    assert lines.count() == 2 and manifest.count() == 2
    again, _ = landing.spend_pull(files(), spark.createDataFrame(manifest.collect(), manifest.schema), 3)
    assert again.count() == 0


def index(spark, value):
    return landing.advertised(spark.createDataFrame([(json.dumps(value),)], "content string"))


def test_index_shapes(spark):
    good = ["spend_data_2026-07-21.json", {"file": "a/spend_data_2026-07-22.json"}, "README.txt"]
    for shape in (good, {"files": good}):
        assert sorted(map(tuple, index(spark, shape).collect())) == [("2026-07-21", "spend_data_2026-07-21.json"), ("2026-07-22", "spend_data_2026-07-22.json")]
    for bad in ({"x": 1}, [], ["README.txt"], "text"):
        with pytest.raises(Exception, match="file index"):
            index(spark, bad).collect()


def test_windows(spark):
    dts = lambda *a, **k: [r.dt for r in landing.window(spark, *a, **k).orderBy("dt").collect()]
    assert dts(today="2025-07-10") == [f"2025-07-{d:02}" for d in range(4, 11)] and len(dts()) == landing.LOOKBACK_DAYS
    assert dts("2025-07-09", "2025-07-10") == ["2025-07-09", "2025-07-10"]
    with pytest.raises(Exception, match="ends before its start"):
        dts("2025-07-10", "2025-07-09")
    media = spark.createDataFrame([("a",), ("b",)], "hashed_id string")
    assert sorted(r.pull_key for r in landing.pulls(landing.window(spark, "2025-07-09", "2025-07-11"), media).collect())[:2] == ["events#a#2025-07-09", "events#a#2025-07-10"]


def test_land_overwrites_only_its_days(spark, tmp_path):
    root = str(tmp_path / "b")
    mk = lambda *r: spark.createDataFrame(r, "raw string, dt string")
    bronze.land(mk(("1", "2025-01-01"), ("2", "2025-01-02")), root, "wistia_visitor_event")
    bronze.land(mk(("3", "2025-01-02")), root, "wistia_visitor_event")
    assert sorted((r.raw, r.dt) for r in bronze.read(spark, root, "wistia_visitor_event").collect()) == [("1", "2025-01-01"), ("3", "2025-01-02")]


def test_snapshots_and_typed_attributes(spark):
    raw = '{"lead_id": {"S": "l1"}, "n": {"N": "3"}, "ok": {"BOOL": true}, "gone": {"NULL": true}}'
    df = spark.createDataFrame([(raw,)], "raw string").select(*landing.flatten_typed("raw", {"lead_id": "string", "n": "int", "ok": "boolean", "gone": "string"}))
    assert df.first().asDict() == {"lead_id": "l1", "n": 3, "ok": True, "gone": None}
    assert landing.export_snapshot(df, "2025-07-12").first().asDict() == {"raw": '{"lead_id":"l1","n":3,"ok":true}', "asof": "2025-07-12"}
    assert spark.range(1).select(landing.canonical(F.lit('{"b": 1, "a": 2}')).alias("x")).first().x == '{"a":2,"b":1}'


def test_synthetic_events_replay(spark):
    out = landing.crm_events(landing.synthetic_events(spark, 9, repeat=2))
    assert out.count() == 18 and landing.once(out).count() == 9 and out.where("status_code <> 200").count() == 0


def test_signatures_are_not_interchangeable(spark):
    key, body, now = "ab" * 32, '{"a":1}', 1000.0
    crm_sig = hmac.new(bytes.fromhex(key), f"1000{body}".encode(), hashlib.sha256).hexdigest()
    ok = {"close-sig-hash": crm_sig, "CLOSE-SIG-TIMESTAMP": "1000"}
    assert signature.verify_crm(ok, body, key, now=now) == (True, "verified")
    assert not signature.verify_crm(ok, body + " ", key, now=now)[0] and not signature.verify_crm(ok, body, key, now=now + 301)[0] and not signature.verify_crm(ok, body, "zz", now=now)[0]
    assert not signature.verify_crm({}, body, key, now=now)[0] and not signature.verify_crm(ok | {"CLOSE-SIG-TIMESTAMP": "x"}, body, key, now=now)[0]
    text_sig = hmac.new(key.encode(), f"1000.{body}".encode(), hashlib.sha256).hexdigest()
    head = {"calendly-webhook-signature": f"t=1000, v1={text_sig}"}
    assert signature.verify_booking(head, body, key, now=now)[0] and not signature.verify_booking({"calendly-webhook-signature": f"t=1000,v1={crm_sig}"}, body, key, now=now)[0]
    assert signature.verify_booking(None, body, None, required=False)[0] and not signature.verify_booking(None, body, None)[0]
    df = spark.createDataFrame([(head, body), (head, "x"), (None, None)], "h map<string,string>, b string")
    assert [r.ok for r in df.select(signature.verified("booking", key, now)("h", "b").alias("ok")).collect()] == [True, False, False]


@pytest.mark.parametrize("scheme", ["crm", "booking"])
@pytest.mark.parametrize("key", ["ab" * 32, "cd" * 70, "zz", None])
def test_columns_judge_as_requests_do(spark, scheme, key):
    """Every way of being wrong, in both schemes, with short, long, unfit and no keys: columns and the plain functions agree in word and reason."""
    verify = {"crm": signature.verify_crm, "booking": signature.verify_booking}[scheme]
    now, cases = 1_000_000.5, []
    for raw in (bytes.fromhex(key) if key and key != "zz" else b"?", (key or "?").encode()):
        for joint in ("", "."):
            for stamp in ("1000000", " 1000000", "999700", "999701", "1000301", "-5", "1e6", "", "12.5", "9" * 30):
                for body in ('{"a": "\u00fc"}', "", None):
                    made = hmac.new(raw, f"{stamp}{joint}{body or ''}".encode(), hashlib.sha256).hexdigest()
                    for sig in (made, made.upper(), made[:-1], ""):
                        cases.append(({"close-SIG-hash": sig, "Close-Sig-Timestamp": stamp}, body))
                        cases.append(({"CALENDLY-webhook-signature": f"t={stamp}, v1={sig}"}, body))
    made = hmac.new((key or "?").encode(), b"1000000.x", hashlib.sha256).hexdigest()
    texts = ("", "t", "t=1,v1", f"v1={made} ,\tt=1000000", f"t=5,t=1000000,v1=0,v1={made}", f"t=1000000,v1={made}=", f"tt=1,xv1=2,t=1000000,v1={made},,=")
    cases += [({"Calendly-Webhook-Signature": t}, "x") for t in texts] + [({}, "x"), (None, "x"), ({"close-sig-hash": "a"}, None)]
    df = spark.createDataFrame(cases, "h map<string,string>, b string").coalesce(1)
    for required in (True, False):
        got = df.select(signature.verdict(scheme, key, "h", "b", required, now).alias("v")).collect()
        assert [(r.v.ok, r.v.why) for r in got] == [verify(h, b or "", key, required, now) for h, b in cases]
    assert key in ("zz", None) or any(r.v.ok for r in got)


def test_signatures_stay_out_of_python(spark):
    df = spark.createDataFrame([({"a": "b"}, "x")], "h map<string,string>, b string")
    plan = df.select(signature.verified("crm", "ab" * 32)("h", "b"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_answers_are_sorted_into_final_and_passing():
    script = [(503, b"busy"), (0, b"timed out"), (200, b"{broken"), (200, b"[1]")]
    waited = []
    client = paged.Client("http://u", waits=(1.0, 2.0, 3.0), transport=lambda *_: script.pop(0), sleep=waited.append)
    assert client.ask({"a": 1}) == [1] and waited == [1.0, 2.0, 3.0]
    with pytest.raises(paged.Refused):
        paged.Client("http://u", transport=lambda *_: (404, b"no")).ask({})
    with pytest.raises(paged.Unavailable):
        paged.Client("http://u", waits=(1.0,), transport=lambda *_: (429, b""), sleep=waited.append).ask({})
    data = [{"n": n} for n in range(230)]
    page = lambda _, q, __: (200, json.dumps(data[(q["page"] - 1) * q["per_page"] : q["page"] * q["per_page"]]).encode())
    assert list(paged.Client("http://u", transport=page).window({})) == data
    assert list(paged.Client("http://u", transport=lambda *_: (200, b'{"id": 1}')).window({})) == [{"id": 1}]
    with pytest.raises(paged.Unavailable, match="narrow"):
        list(paged.Client("http://u", transport=lambda _, q, __: (200, json.dumps([0] * q["per_page"]).encode())).window({}))


class Api(http.server.BaseHTTPRequestHandler):
    """Two media; their events of a day in pages, daily stats, and metadata as one object. The first request of all is refused for now."""

    asked: list = []

    def do_GET(self):
        url = urllib.parse.urlparse(self.path)
        q = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
        Api.asked.append(self.headers.get("Authorization"))
        rows = [{"event_key": f"{q.get('media_id')}-{q.get('start_date')}-{n}", "a": 1} for n in range(130 if q.get("media_id") == "m1" else 0)]
        body = {"hashed_id": url.path[len("/media/") :], "name": "x"} if url.path.startswith("/media/") else rows[(int(q["page"]) - 1) * 100 : int(q["page"]) * 100]
        self.send_response(503 if len(Api.asked) == 1 else 200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *_):
        pass


@pytest.fixture
def api():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_paged_source_through_spark(spark, api, tmp_path):
    paged.register(spark)
    pull = spark.read.format("paged_events").option("media", "m1,m2").option("token", "t").option("waits", "0.01,0.01")
    events = pull.option("url", f"{api}/events").option("days", "2025-07-09,2025-07-10").load()
    days, media = landing.window(spark, "2025-07-09", "2025-07-10"), spark.createDataFrame([("m1",), ("m2",)], "hashed_id string")
    objects = landing.pull_objects(landing.pulls(days, media), events, "events")
    root = str(tmp_path / "b")
    landing.land_pulls(objects, root)
    assert "Bearer t" in Api.asked
    rows = bronze.read(spark, root, "wistia_visitor_event")
    assert rows.count() == 260 and rows.select("dt").distinct().count() == 2
    assert (tmp_path / "b/wistia/visitor_events/dt=2025-07-09/m2.json").read_text() == ""  # asked, nothing there
    meta = spark.read.format("paged_events").option("media", "m1,m2").option("url", f"{api}/media/{{hashed_id}}").load()
    assert sorted((r.hashed_id, r.dt, json.loads(r.raw)["name"]) for r in meta.collect()) == [("m1", None, "x"), ("m2", None, "x")]


def test_events_of_a_day_stay(spark, tmp_path):
    """A second event of the same day doesn't delete the first, and a redelivery is no second event."""
    root = str(tmp_path / "b")
    for batch in ([crm("ev_1")], [crm("ev_2")], [crm("ev_1")]):
        landing.land_events(landing.crm_events(bodies(spark, *batch)), root)
    got = bronze.read(spark, root, "crm_event").collect()
    assert sorted(json.loads(r.raw)["event"]["id"] for r in got) == ["ev_1", "ev_2"] and {r.dt for r in got} == {"2025-05-20"}
    pretty = spark.createDataFrame([(json.dumps(crm("ev_3"), indent=2),)], "body string")
    landing.land_events(landing.crm_events(pretty), root)
    assert bronze.read(spark, root, "crm_event").count() == 3
    landing.land_events(landing.booking_events(bodies(spark, booking("m", "i"), booking("m", "i2"))), root)
    assert bronze.read(spark, root, "calendly_booking").count() == 2


def test_daily_stats_keep_their_medium(spark, tmp_path):
    root = str(tmp_path / "b")
    days, media = landing.window(spark, "2025-07-09", "2025-07-09"), spark.createDataFrame([("m1",), ("m2",)], "hashed_id string")
    stats = spark.createDataFrame([(m, "2025-07-09", json.dumps({"date": "2025-07-09", "load_count": n, "play_count": 1, "hours_watched": 0.5})) for m, n in (("m1", 5), ("m2", 7))], "hashed_id string, dt string, raw string")
    landing.land_pulls(landing.pull_objects(landing.pulls(days, media, "stats"), stats, "stats"), root)
    out = silver.fct_media_daily_stats(silver.BuildContext("b", "2025-07-12"), bronze.read_all(spark, root)).collect()
    assert sorted((r.hashed_id, r.load_count) for r in out) == [("m1", 5), ("m2", 7)]


def test_keys_and_identification(spark):
    keys = spark.createDataFrame([("crm%2Fevents/dt%3D2025-05-20/a+b.json",), ("%zz",)], "k string").select(landing.object_key("k").alias("k")).collect()
    assert [r.k for r in keys] == ["crm/events/dt=2025-05-20/a b.json", None]
    e = spark.createDataFrame([("a@x",), (" ",), (None,), (None,)], "email string")
    assert landing.identification(e).first().asDict() == {"events": 4, "identified": 1, "identification_rate": 0.25}
    assert landing.identification(e.where("false")).first().identification_rate is None


def test_unlike_bodies_need_an_order(spark, tmp_path):
    old, new = crm("ev_1", label="zzz"), crm("ev_1", label="aaa")
    both = bodies(spark, old, new).withColumn("at", F.when(F.col("body").contains("aaa"), 2).otherwise(1))
    with pytest.raises(Exception, match="an order is needed"):
        landing.land_events(landing.crm_events(both), str(tmp_path / "b"))
    landing.land_events(landing.crm_events(both), str(tmp_path / "b"), order="at")
    got = bronze.read(spark, str(tmp_path / "b"), "crm_event").collect()
    assert [json.loads(r.raw)["event"]["data"]["status_label"] for r in got] == ["aaa"]


def test_what_cannot_be_stored_is_answered_with_500(spark, tmp_path):
    """A file stands where the second day's folder should be: its event gets 500, the others are stored and keep their status."""
    root = tmp_path / "b"
    (root / "crm/events").mkdir(parents=True)
    (root / "crm/events/dt=2025-05-21").write_text("in the way")
    late = crm("ev_2")
    late["event"]["date_created"] = "2025-05-21T00:00:00"
    said = landing.answer(landing.crm_events(bodies(spark, crm("ev_1"), late, {"event": {}})), str(root), str(tmp_path / "answers"))
    assert sorted((r.status_code, r.dt) for r in said.collect() if r.dt) == [(200, "2025-05-20"), (500, "2025-05-21")]
    assert said.where("status_code = 400").count() == 1 and (root / "crm/events/dt=2025-05-20/crm_event_ev_1.json").exists()
    (root / "crm/events/dt=2025-05-21").unlink()  # the sender tries again
    said = landing.answer(landing.crm_events(bodies(spark, late)), str(root), str(tmp_path / "answers"))
    assert [r.status_code for r in said.collect()] == [200] and bronze.read(spark, str(root), "crm_event").count() == 2


def test_streamed_redelivery_lands_once(spark, tmp_path):
    """The same event in one batch, in a later one, and beyond the watermark: stored once, dropped, replaced by itself."""
    inbox, root = tmp_path / "in", tmp_path / "b"
    inbox.mkdir()

    def deliver(name, *events):
        (inbox / name).write_text("".join(json.dumps({"body": json.dumps(e), "at": at}) + "\n" for e, at in events))
        stream = spark.readStream.schema("body string, at timestamp").json(str(inbox))
        landing.land_stream(stream, str(root), str(tmp_path / "ckpt"), within="1 hour").awaitTermination()

    file = root / "crm/events/dt=2025-05-20/crm_event_ev_1.json"
    deliver("a.json", (crm("ev_1"), "2025-05-20T12:00:00Z"), (crm("ev_1"), "2025-05-20T12:00:01Z"), (crm("ev_2"), "2025-05-20T12:00:02Z"))
    assert bronze.read(spark, str(root), "crm_event").count() == 2
    first = file.stat().st_ino
    deliver("b.json", (crm("ev_1"), "2025-05-20T12:10:00Z"), (crm("ev_3"), "2025-05-20T12:10:00Z"), (crm("ev_3"), "2025-05-20T12:10:00Z"))
    assert file.stat().st_ino == first and bronze.read(spark, str(root), "crm_event").count() == 3
    deliver("c.json", (crm("ev_4"), "2025-05-21T12:00:00Z"))
    deliver("d.json", (crm("ev_1"), "2025-05-21T12:00:01Z"))
    assert file.stat().st_ino != first and bronze.read(spark, str(root), "crm_event").count() == 4


def spend_files(spark, **by_day):
    rows = [(d.replace("_", "-"), f"spend_data_{d}.json", body, hashlib.sha256(body.encode()).hexdigest(), len(body)) for d, body in by_day.items()]
    return spark.createDataFrame(rows, "asof string, filename string, content string, content_hash string, size_bytes long")


def test_spend_runs_at_once_keep_both_entries(spark, tmp_path):
    """Two runs read the manifest before either records: both files are landed and recorded; a third run has nothing to do, a corrected file comes again."""
    row = json.dumps([{"date": "2025-07-01", "channel": "x", "spend": 1.0}])
    manifest = StateTable(spark, str(tmp_path / "m"), landing.MANIFEST)
    start, out = threading.Barrier(2, timeout=60), []
    first = spend_files(spark, **{"2025_07_01": row}), spend_files(spark, **{"2025_07_02": row})
    real = landing.classify

    def at_once(files, known):
        if len(out) == 0 and not getattr(seen, "done", False):
            seen.done = True
            start.wait()
        return real(files, known)

    seen = threading.local()
    landing.classify = at_once
    try:
        many = [threading.Thread(target=lambda f=f: out.append(landing.land_spend(spark, f, str(tmp_path / "b"), manifest, 5))) for f in first]
        [t.start() for t in many]
        [t.join() for t in many]
    finally:
        landing.classify = real
    assert sorted(x for o in out for x in o) == ["2025-07-01", "2025-07-02"]
    assert {(r.asof, r.row_count, r.channels) for r in manifest.read().collect()} == {("2025-07-01", 1, "x"), ("2025-07-02", 1, "x")}
    assert bronze.read(spark, str(tmp_path / "b"), "calendly_spend").count() == 2
    both = first[0].union(first[1])
    assert landing.land_spend(spark, both, str(tmp_path / "b"), manifest, 6) == []
    assert landing.land_spend(spark, spend_files(spark, **{"2025_07_01": row.replace("1.0", "2.0"), "2025_07_03": "{broken"}), str(tmp_path / "b"), manifest, 7) == ["2025-07-01"]
    assert {(r.asof, r.pulled_at) for r in manifest.read().collect()} == {("2025-07-01", 7), ("2025-07-02", 5)}
