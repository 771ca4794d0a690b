"""Operators of the edge as named queries: signed and encoded requests, published indexes, exports, worklists, served figures. Inputs are made of the star
tables, the SQL says the same by other means."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dialect import hour_of, iso_dow, json_scalar, local_ts
from millrace.operators import gold
from millrace.plans import serve
from millrace.plans.feed_showcase import later, text
from millrace.plans.showcase import CTX, bookings, table
from millrace.sources import landing, signature
from millrace.streaming import alerts

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: The key that the queries' requests are signed with, and the time at which they are judged.
KEY, NOW = hashlib.sha256(b"showcase").hexdigest(), 1_700_000_000


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# ---- requests ----------------------------------------------------------------------------------------------------------


def _hmac_sql(key: bytes, message: str) -> str:
    pads = ["".join(f"{b ^ pad:02x}" for b in key.ljust(64, b"\0")) for pad in (0x36, 0x5C)]
    return f"sha256(unhex('{pads[1]}') || unhex(sha256(unhex('{pads[0]}') || encode({message}))))"


_SIGNED_SQL = f"""
WITH e AS (SELECT event_id AS k, CASE event_id % 8 WHEN 3 THEN {NOW} - 301 WHEN 4 THEN {NOW} + 300 ELSE {NOW} END AS t,
  '{{"event":{{"id":"e' || event_id || '","date_created":"' || strftime(ts, '%Y-%m-%d') || '","name":"[' || event_type || ']"}}}}' AS body, strftime(ts, '%Y-%m-%d') AS dt FROM events),
s AS (SELECT *, {_hmac_sql(bytes.fromhex(KEY), "t || body")} AS crm, {_hmac_sql(KEY.encode(), "t || '.' || body")} AS booking FROM e)"""


def _signed(spark, d) -> DataFrame:
    """Requests of which each eighth is altered, unsigned, too old, nearly so, signed by the other scheme, without a whole number for a time, or in capitals."""
    k = F.col("event_id")
    kind = k % 8
    event = F.struct(F.concat(F.lit("e"), text(k)).alias("id"), F.date_format("ts", "yyyy-MM-dd").alias("date_created"), F.concat(F.lit("["), "event_type", F.lit("]")).alias("name"))
    e = table(spark, d, "events").select(k, kind.alias("kind"), F.to_json(F.struct(event.alias("event"))).alias("sent"), text(F.when(kind == 3, NOW - 301).when(kind == 4, NOW + 300).otherwise(NOW)).alias("t"))
    e = e.withColumn("crm", signature.hmac_sha256(bytes.fromhex(KEY), F.concat("t", "sent"))).withColumn("booking", signature.hmac_sha256(KEY.encode(), F.concat("t", F.lit("."), "sent")))
    at = F.when(F.col("kind") == 6, "soon").otherwise(F.col("t"))
    shown = lambda right, wrong: F.when(F.col("kind") == 5, F.col(wrong)).when(F.col("kind") == 7, F.upper(right)).otherwise(F.col(right))
    crm = F.create_map(F.lit("CLOSE-sig-timestamp"), at, F.lit("close-SIG-hash"), shown("crm", "booking"))
    both = F.create_map(F.lit("calendly-WEBHOOK-signature"), F.concat(F.lit("v1="), shown("booking", "crm"), F.lit(" , t="), at))
    none = F.create_map(F.lit("host"), F.lit("x"))
    body = F.when(F.col("kind") == 1, F.concat("sent", F.lit(" "))).otherwise(F.col("sent"))
    return e.select("event_id", "crm", "booking", body.alias("body"), F.when(F.col("kind") == 2, none).otherwise(crm).alias("crm_headers"), F.when(F.col("kind") == 2, none).otherwise(both).alias("booking_headers"))


@query(_SIGNED_SQL + """
SELECT k AS event_id, crm AS crm_signature, booking AS booking_signature, k % 8 IN (0, 4) AS ok,
  CASE k % 8 WHEN 0 THEN 'verified' WHEN 4 THEN 'verified' WHEN 2 THEN 'signature header missing or malformed' WHEN 3 THEN 'timestamp is outside the replay window by its age of 301 s'
    WHEN 6 THEN 'timestamp isn''t an integer' ELSE 'signatures differ' END AS why FROM s""")
def webhook_signatures(spark, d):
    """Both schemes over the same requests: they agree on who is refused and why."""
    crm = signature.verdict("crm", KEY, "crm_headers", "body", now=NOW)
    other = signature.verdict("booking", KEY, "booking_headers", "body", now=NOW)
    out = _signed(spark, d).withColumn("a", crm).withColumn("b", other)
    return out.select("event_id", F.col("crm").alias("crm_signature"), F.col("booking").alias("booking_signature"), (F.col("a.ok") & F.col("b.ok")).alias("ok"), F.when(F.col("a.why") == F.col("b.why"), F.col("a.why")).alias("why"))


@query(_SIGNED_SQL + """
SELECT k AS event_id, CASE WHEN k % 11 = 0 THEN 400 WHEN k % 8 IN (0, 4) THEN 200 ELSE 401 END AS status, CASE WHEN k % 11 <> 0 AND k % 8 IN (0, 4) THEN 'crm/events/dt=' || dt || '/crm_event_e' || k || '.json' END AS key FROM s""")
def webhook_statuses(spark, d):
    """Malformed bodies are 400 whatever their signature, well-formed ones with a bad signature 401 and without a key. Every second body comes in base64."""
    k = F.col("event_id")
    asked = _signed(spark, d).withColumn("coded", k % 2 == 0)
    asked = asked.withColumn("carried", F.when(F.col("coded"), F.base64(F.encode("body", "utf-8"))).otherwise(F.col("body")))
    asked = asked.withColumn("body", landing.body_of("carried", "coded"))
    asked = asked.withColumn("signed", signature.verified("crm", KEY, NOW)("crm_headers", "body")).withColumn("body", F.when(k % 11 == 0, '{"event": {}}').otherwise(F.col("body")))
    return landing.with_signature(landing.crm_events(asked), "signed").select("event_id", F.col("status_code").alias("status"), "key")


@query("""
SELECT doc_id, CASE WHEN text IS NOT NULL THEN md5(text) END AS body_md5, CASE WHEN doc_id % 7 <> 0 AND text IS NOT NULL THEN md5(text) END AS key_md5 FROM documents""")
def decoded_requests(spark, d):
    """Whole texts as base64 bodies and as percent-encoded object keys; each seventh key is broken and gives null."""
    i = F.col("doc_id")
    docs = table(spark, d, "documents").select("doc_id", F.base64(F.encode("text", "utf-8")).alias("carried"), F.when(i % 7 == 0, F.concat(F.coalesce(F.url_encode("text"), F.lit("")), F.lit("%zz"))).otherwise(F.url_encode("text")).alias("name"))
    return docs.select("doc_id", F.md5(landing.body_of("carried", F.lit(True))).alias("body_md5"), F.md5(landing.object_key("name")).alias("key_md5"))


@query("""
SELECT c AS lead_id, strftime(seen, '%Y-%m-%d %H:%M:%S') || '#' || k AS last, n AS deliveries FROM (
  SELECT o_custkey AS c, o_orderdate AS seen, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE rn = 1""")
def redelivered_events(spark, d):
    """Bodies that share a key: the last delivered stays, ties by the body."""
    o = table(spark, d, "orders")
    seen = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    sent = o.select(text(F.col("o_custkey")).alias("key"), F.col("o_orderdate").alias("at"), F.concat(seen, F.lit("#"), text(F.col("o_orderkey"))).alias("raw"))
    count = sent.groupBy("key").agg(F.count("*").alias("deliveries"))
    return landing.once(sent, "at").join(count, "key").select(F.col("key").cast("long").alias("lead_id"), F.col("raw").alias("last"), "deliveries")


# ---- published files and exports ---------------------------------------------------------------------------------------


@query("""
SELECT DISTINCT strftime(day, '%Y-%m-%d') AS asof, 'spend_data_' || strftime(day, '%Y-%m-%d') || '.json' AS filename FROM (
  SELECT unnest([CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 1]) AS day FROM orders)""")
def advertised_files(spark, d):
    """An index of two days an order, in each of the shapes that an index may have, beside names that are no spend file's."""
    k = F.col("o_orderkey")
    name = lambda n: F.concat(F.lit("spend_data_"), F.date_format(F.date_add(F.to_date("o_orderdate"), n), "yyyy-MM-dd"), F.lit(".json"))
    plain = F.to_json(F.array(name(0), F.lit("README.json"), F.concat(F.lit("data/v1/"), name(1)), F.lit("spend_data_2024-1-1.json")))
    nested = F.to_json(F.struct(F.array(F.struct(name(0).alias("file"), F.lit(1).alias("size")), F.struct(F.concat(F.lit("x/"), name(1)).alias("file"), F.lit(2).alias("size"))).alias("files")))
    listed = F.to_json(F.struct(F.array(name(1), name(0)).alias("files")))
    content = F.when(k % 3 == 0, plain).when(k % 3 == 1, nested).otherwise(listed)
    return landing.advertised(table(spark, d, "orders").select(content.alias("content")))


@query("""
SELECT c_custkey, '{"c_custkey":' || c_custkey || CASE WHEN c_custkey % 3 <> 0 THEN ',"email":"c' || c_custkey || '@x.com"' ELSE '' END || ',"owner":"[' || c_nationkey || ']"}' AS raw, '2024-02-01' AS asof FROM customer""")
def owner_export(spark, d):
    """A keyed table's rows as lines with sorted keys; absent fields are left out."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(F.concat(F.lit("["), text(F.col("c_nationkey")), F.lit("]")).alias("owner"), k, F.when(k % 3 != 0, F.concat(F.lit("c"), text(k), F.lit("@x.com"))).alias("email"))
    out = landing.export_snapshot(rows, CTX.asof)
    return out.select(json_scalar("raw", "$.c_custkey").cast("long").alias("c_custkey"), "raw", "asof")


@query("""
SELECT o_orderkey, o_orderpriority AS label, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey ELSE -1 END AS tries, o_orderkey % 2 = 0 AS open, true AS nothing FROM orders""")
def typed_attributes(spark, d):
    """Attributes that carry their types, flattened; a text that isn't a number, an explicit null and an absent attribute are null."""
    k = F.col("o_orderkey")
    number = F.struct(F.when(k % 3 != 0, text(F.col("o_custkey"))).otherwise("many").alias("N"))
    item = F.struct(F.struct(F.col("o_orderpriority").alias("S")).alias("label"), number.alias("try count"), F.when(k % 2 == 0, F.struct(F.lit(True).alias("BOOL"))).alias("open"), F.struct(F.lit(True).alias("NULL")).alias("nothing"))
    kinds = {"label": "string", "try count": "long", "open": "boolean", "nothing": "string"}
    flat = table(spark, d, "orders").select(k, F.to_json(item).alias("raw")).select("o_orderkey", *landing.flatten_typed("raw", kinds))
    return flat.select("o_orderkey", "label", F.coalesce("try count", F.lit(-1)).alias("tries"), F.coalesce("open", F.lit(False)).alias("open"), F.col("nothing").isNull().alias("nothing"))


# ---- worklist ----------------------------------------------------------------------------------------------------------


def _worklist(spark, d) -> DataFrame:
    c = F.col("c_custkey")
    tried = F.when(c % 5 != 0, 1000 - c % 97).cast("long")
    status = F.when(c % 7 == 0, "EXHAUSTED").otherwise("AWAITING")
    return table(spark, d, "customer").select(text(c).alias("lead_id"), F.concat(F.lit("e"), text(c)).alias("event_id"), F.lit(1).cast("long").alias("first_seen_at"), (c % 25).cast("int").alias("retry_count"), status.alias("status"), tried.alias("last_attempt_at"))


_WORK_SQL = """
WITH w AS (SELECT CAST(c_custkey AS VARCHAR) AS lead_id, c_custkey AS c, CAST(c_custkey % 25 AS INTEGER) AS n, CASE WHEN c_custkey % 7 = 0 THEN 'EXHAUSTED' ELSE 'AWAITING' END AS status, CASE WHEN c_custkey % 5 <> 0 THEN 1000 - c_custkey % 97 END AS tried FROM customer)"""


@query(_WORK_SQL + " SELECT lead_id, coalesce(tried, -1) AS last_attempt_at FROM w WHERE status = 'AWAITING' ORDER BY tried NULLS FIRST, lead_id LIMIT 500")
def longest_waiting(spark, d):
    """Whose turn it is in a sweep of five hundred."""
    return alerts.longest_waiting(_worklist(spark, d), 500).select("lead_id", F.coalesce("last_attempt_at", F.lit(-1)).alias("last_attempt_at"))


@query(_WORK_SQL + """
SELECT lead_id, CASE WHEN c % 6 = 5 THEN n + 1 WHEN status = 'AWAITING' AND c % 11 <> 0 THEN n + 1 ELSE n END AS retry_count,
  CASE WHEN c % 6 <> 5 AND status = 'AWAITING' AND c % 11 <> 0 AND n + 1 >= 24 THEN 'EXHAUSTED' ELSE status END AS status,
  CASE WHEN c % 6 <> 5 AND status = 'AWAITING' AND c % 11 <> 0 THEN 2000 ELSE coalesce(tried, -1) END AS last_attempt_at
FROM w WHERE NOT (status = 'AWAITING' AND c % 4 = 0 AND c % 6 <> 5 AND c % 11 <> 0)""")
def sweep_applied(spark, d):
    """A sweep takes effect on a worklist that another writer has changed since, in each sixth row; lookups of each eleventh lead broke."""
    c = F.col("lead_id").cast("long")
    work = _worklist(spark, d)
    swept = alerts.sweep(work, work.where(c % 4 == 0), now=2000, failed=work.where(c % 11 == 0))
    now = work.withColumn("retry_count", F.when(c % 6 == 5, F.col("retry_count") + 1).otherwise(F.col("retry_count")))
    return alerts.apply_sweep(now, swept).select("lead_id", "retry_count", "status", F.coalesce("last_attempt_at", F.lit(-1)).alias("last_attempt_at"))


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'kept ' || o_custkey WHEN o_custkey % 2 = 0 THEN 'found ' || o_custkey END AS lead_owner,
  CASE WHEN o_custkey % 3 <> 0 AND o_custkey % 4 = 0 THEN 'c' || o_custkey || '@x.com' END AS lead_email, o_custkey % 3 = 0 OR o_custkey % 2 = 0 AS found FROM orders""")
def owner_resolution(spark, d):
    """Owners from the cache first, then from the source; who is in neither stays without, and blanks are no answers."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    asked = table(spark, d, "orders").select("o_orderkey", text(F.col("o_custkey")).alias("lead_id"))
    raw = lambda who, mail: F.to_json(F.struct(F.concat(F.lit(who), text(k)).alias("lead_owner"), F.when(mail, F.concat(F.lit("c"), text(k), F.lit("@x.com"))).otherwise("").alias("lead_email")))
    cache = landing.owner_rows(c.where(k % 3 == 0).select(text(k).alias("lead_id"), raw("kept ", F.lit(False)).alias("raw")), 1)
    source = c.where(k % 2 == 0).select(text(k).alias("lead_id"), raw("found ", k % 4 == 0).alias("raw"))
    return alerts.resolve(asked, cache, source, 2)[0].select("o_orderkey", "lead_owner", "lead_email", "found")


# ---- served figures ----------------------------------------------------------------------------------------------------


@query("""
WITH e AS (SELECT CASE WHEN user_id % 5 <> 0 THEN 'm' || user_id % 20 END AS media_name, count(*) AS loads, count(*) FILTER (event_type = 'view') AS plays FROM events WHERE user_id % 5 <> 0 GROUP BY 1),
b AS (SELECT * FROM e UNION ALL SELECT NULL, sum(loads), sum(plays) FROM e)
SELECT coalesce(media_name, 'all') AS media_name, CAST(loads AS BIGINT) AS loads, CAST(plays AS BIGINT) AS plays, CAST(plays AS DOUBLE) / loads AS play_rate FROM b""")
def served_play_rates(spark, d):
    """A rate each and one of all together, each divided once."""
    e = table(spark, d, "events").where("user_id % 5 <> 0").groupBy("user_id").agg(F.count("*").alias("load_count"), F.count_if(F.col("event_type") == "view").alias("play_count"))
    return serve.play_rates(e.withColumn("media_name", F.concat(F.lit("m"), text(F.col("user_id") % 20)))).withColumn("media_name", F.coalesce("media_name", F.lit("all")))


@query("""
WITH o AS (SELECT o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) AS start FROM orders),
t AS (SELECT timezone('America/New_York', start AT TIME ZONE 'UTC') AS t FROM o)
SELECT hour(t) AS hour_of_day, isodow(t) AS day_of_week, count(*) AS bookings, (['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'])[isodow(t)] AS dow_label FROM t GROUP BY 1, 2, 4""")
def served_heatmap(spark, d):
    """Bookings by hour and weekday of business time, from the mart of time slots."""
    start = local_ts(later(F.col("o_orderdate"), F.col("o_orderkey") % 24))
    none = F.lit(None).cast("int")
    b = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("channel"), (F.col("o_orderstatus") == "F").alias("is_canceled"), F.lit(True).alias("missing_invitee_timezone"), none.alias("start_hour_invitee_local"),
        none.alias("start_dow_invitee_local"), hour_of(start).alias("start_hour_business_est"), iso_dow(start).alias("start_dow_business_est"),
    )
    slots = gold.booking_time_slots(CTX, {"fct_booking": b})
    return serve.heatmap(slots, "business_est").select("hour_of_day", "day_of_week", "bookings", "dow_label")


@query("""
SELECT channel, CASE channel WHEN 'other' THEN 'Other / organic' ELSE channel END AS channel_label, count(*) AS bookings, count(*) FILTER (k % 2 = 0) AS with_email, CAST(count(*) FILTER (k % 2 = 0) AS DOUBLE) / count(*) AS email_coverage FROM (
  SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE o_orderpriority END AS channel FROM orders) GROUP BY 1""")
def served_funnel(spark, d):
    """Sums by channel over the days of a funnel, with display names and coverage."""
    o = bookings(spark, d).withColumn("mail", F.when(F.col("scheduled_event_uri") % 2 == 0, 1).otherwise(0))
    days = o.groupBy("channel", "booking_date_est").agg(F.count("*").alias("bookings"), F.sum("mail").alias("bookings_with_email"), F.lit(0).alias("bookings_with_prior_video"))
    return serve.funnel_by_channel(days).select("channel", "channel_label", "bookings", F.col("bookings_with_email").alias("with_email"), "email_coverage")


@query("SELECT event_id, user_id, value FROM events WHERE event_id = (SELECT max(event_id) FROM events)")
def served_latest(spark, d):
    """The last row of a served table."""
    return serve.latest(table(spark, d, "events"), "event_id").select("event_id", "user_id", "value")
