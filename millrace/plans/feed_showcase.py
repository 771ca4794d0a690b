"""Silver tables, landing and notices as named queries: feeds of JSON lines made of the star tables go through the library's own builders.

An order is a booking's invitee (three in a row share a meeting) or a CRM event of its customer; a part is a medium."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dialect import json_fields
from millrace.operators import gold, silver
from millrace.plans.showcase import CTX, bookings, lines, spend, table
from millrace.sources import landing
from millrace.streaming import alerts

QUERIES: dict = {}
SQL: dict[str, str] = {}
_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
_ZONES = ("Asia/Kolkata", "America/Los_Angeles", "Europe/Berlin", None)


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def stamp(c: Column) -> Column:
    return F.date_format(c, _STAMP)


def later(c: Column, hours: Column | int) -> Column:
    return F.timestamp_seconds(F.unix_seconds(c.cast("timestamp")) + hours * F.lit(3600))


def text(c: Column) -> Column:
    return c.cast("string")


# ---- JSON --------------------------------------------------------------------------------------------------------------


@query("""
SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN '[VIP] ' || event_type WHEN 1 THEN '{{campaign.name}}' WHEN 4 THEN CAST(event_id AS VARCHAR) WHEN 5 THEN '[1]' END AS name,
  CASE WHEN event_id % 2 = 0 THEN 'true' END AS flag,
  CASE event_id % 6 WHEN 2 THEN '{"a":1}' WHEN 3 THEN '[1,2]' END AS nested
FROM events""")
def json_true_scalars(spark, d):
    """Strings that look like arrays or objects stay; arrays and objects don't pass for scalars; numbers and booleans become text."""
    kind = F.col("event_id") % 6
    value = (
        F.when(kind == 0, F.concat(F.lit('"[VIP] '), "event_type", F.lit('"'))).when(kind == 1, '"{{campaign.name}}"').when(kind == 2, '{"a":1}')
        .when(kind == 3, "[1,2]").when(kind == 4, text(F.col("event_id"))).otherwise('"[1]"')
    )
    flag = F.when(F.col("event_id") % 2 == 0, "true").otherwise("[]")
    raw = F.concat(F.lit('{"flag": '), flag, F.lit(', "a": {"name.x": '), value, F.lit(', "twin": '), value, F.lit("}}"))
    paths = {"name": ("a", "name.x"), "flag": ("flag",), "twin": ("a", "twin")}
    out = json_fields(table(spark, d, "events").withColumn("raw", raw), paths, documents=("twin",), keep=("event_id",))
    return out.select("event_id", "name", "flag", F.when((F.col("event_id") % 6).isin(2, 3), F.col("twin")).alias("nested"))


# ---- Silver ------------------------------------------------------------------------------------------------------------

_LEAD_SQL = """
WITH e AS (
  SELECT o_custkey AS c, o_orderkey AS k, o_orderdate AS seen, o_orderpriority AS label, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn FROM orders),
l AS (
  SELECT CAST(c AS VARCHAR) AS lead_id, '[' || label || '] lead' AS display_name, CASE WHEN k % 5 <> 0 THEN label END AS status_label,
    CASE WHEN k % 2 = 0 THEN 'VSL' END AS funnel, CASE WHEN k % 3 = 2 THEN 'updated' ELSE 'created' END AS last_action,
    CASE WHEN c % 2 = 0 THEN 'owner ' || c % 10 END AS lead_owner, CASE WHEN c % 4 = 0 THEN ' Lead' || c || '@X.com ' END AS lead_email,
    CASE WHEN c % 4 = 0 THEN 'lead' || c || '@x.com' END AS lead_email_normalized, seen AS lead_updated_at, c % 4 = 0 AS has_email, c % 2 = 0 AS has_owner,
    CASE WHEN c % 4 = 0 THEN 'ENRICHED' WHEN c % 2 = 0 THEN 'OWNER_ONLY' ELSE 'AWAITING_OWNER' END AS enrichment_status, CAST(k AS VARCHAR) AS source_event_id
  FROM e WHERE rn = 1)"""


def _leads(spark, d) -> tuple[DataFrame, DataFrame]:
    """The leads, and the feed of owners."""
    k = F.col("o_orderkey")
    data = F.struct(
        F.concat(F.lit("["), "o_orderpriority", F.lit("] lead")).alias("display_name"), F.when(k % 5 != 0, F.col("o_orderpriority")).alias("status_label"),
        stamp(F.col("o_orderdate")).alias("date_updated"), F.when(k % 2 == 0, "VSL").alias("custom.cf_1"),
    )
    event = F.struct(text(k).alias("id"), text(F.col("o_custkey")).alias("lead_id"), F.when(k % 3 == 2, "updated").otherwise("created").alias("action"), stamp(F.col("o_orderdate")).alias("date_updated"), data.alias("data"))
    c = F.col("c_custkey")
    # an older snapshot holds other owners
    owners = table(spark, d, "customer").where("c_custkey % 2 = 0").withColumn("asof", F.explode(F.array(F.lit("2024-01-01"), F.lit(CTX.asof))))
    who = F.when(F.col("asof") == CTX.asof, F.concat(F.lit("owner "), text(c % 10))).otherwise("someone else")
    feed = lines(owners, "asof", lead_id=text(c), lead_owner=who, lead_email=F.when(c % 4 == 0, F.concat(F.lit(" Lead"), text(c), F.lit("@X.com "))))
    ctx = silver.BuildContext(CTX.build_id, CTX.asof, "custom.cf_1")
    return silver.dim_lead(ctx, {"crm_event": lines(table(spark, d, "orders"), event=event), "lead_owner": feed}), feed


@query(_LEAD_SQL + " SELECT * FROM l")
def silver_dim_lead(spark, d):
    """The latest event of each customer, with the owners of the build's date only."""
    return _leads(spark, d)[0].drop("build_date", "lead_created_at")


@query(
    _LEAD_SQL
    + """,
a AS (SELECT count(*) AS n, count(*) FILTER (has_email) AS m, count(*) FILTER (has_owner) AS o FROM l),
w AS (SELECT count(*) FILTER (c_custkey % 3 = 0) AS exhausted, count(*) FILTER (c_custkey % 3 = 1) AS awaiting, max(c_custkey % 25) AS top FROM customer),
s AS (SELECT count(*) AS cache FROM customer WHERE c_custkey % 2 = 0)
SELECT n AS total_leads, m AS leads_with_email, o AS leads_with_owner, round(CAST(m AS DOUBLE) / n * 10000.0, 0) / 10000.0 AS email_match_rate,
  round(CAST(o AS DOUBLE) / n * 10000.0, 0) / 10000.0 AS owner_match_rate, awaiting AS awaiting_owner_open, exhausted AS awaiting_owner_exhausted,
  CAST(top AS INTEGER) AS max_retry_count, cache AS owner_cache_size FROM a CROSS JOIN w CROSS JOIN s"""
)
def silver_dq_lead_coverage(spark, d):
    """Coverage of the leads above, with a worklist of the build's date and one of another day that doesn't count."""
    leads, owners = _leads(spark, d)
    c = F.col("c_custkey")
    status = F.when(c % 3 == 0, "EXHAUSTED").when(c % 3 == 1, "AWAITING").otherwise("GONE")
    work = table(spark, d, "customer").withColumn("asof", F.explode(F.array(F.lit("2023-12-31"), F.lit(CTX.asof))))
    feed = lines(work, "asof", lead_id=text(c), status=F.when(F.col("asof") == CTX.asof, status).otherwise("AWAITING"), retry_count=(c % 25).cast("int"))
    return silver.dq_lead_coverage(CTX, {"lead_owner": owners, "awaiting_owner": feed}, leads).drop("build_date", "coverage_caveat")


_BOOKED_SQL = """
WITH o AS (
  SELECT o_orderkey AS k, o_orderkey // 3 AS m, 'm/' || o_orderkey // 3 AS uri, 'm/' || o_orderkey // 3 || '/i/' || o_orderkey AS invitee, o_orderdate AS created,
    o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 24) AS start, o_orderpriority AS et, o_orderstatus AS st, o_custkey AS cust,
    CASE o_orderkey % 4 WHEN 0 THEN 'Asia/Kolkata' WHEN 1 THEN 'America/Los_Angeles' WHEN 2 THEN 'Europe/Berlin' END AS tz FROM orders),
seed AS (SELECT * FROM (VALUES ('1-URGENT', 'paid', true), ('2-HIGH', 'search', true), ('3-MEDIUM', 'mail', false)) AS s(et, channel, paid)),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uri ORDER BY created, invitee) AS rn, count(*) OVER (PARTITION BY uri) AS n FROM o) WHERE rn = 1)"""


def _booking_feed(spark, d, *, copies: bool = False) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    meeting = F.concat(F.lit("m/"), text(F.floor(k / 3)))
    zone = F.get(F.array(*map(F.lit, _ZONES)), (k % 4).cast("int"))
    created = F.col("o_orderdate")
    if copies:  # each invitee lands again a day later
        o = o.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    age = F.col("copy") if copies else F.lit(0)
    host = lambda n, m: F.struct(F.when(F.col("o_custkey") % m != 0, F.concat(F.lit(f"u{n}/"), text(F.col("o_custkey") % m))).alias("user"), F.concat(F.lit(f" H{n}."), text(F.col("o_custkey") % m), F.lit("@X.com")).alias("user_email"), F.lit(f"[host {n}]").alias("user_name"))
    event = F.struct(
        meeting.alias("uri"), F.concat(F.lit("[Call] "), text(F.floor(k / 3))).alias("name"), F.lit("active").alias("status"), F.col("o_orderpriority").alias("event_type"),
        stamp(later(created, k % 24)).alias("start_time"), stamp(later(created, k % 24 + 1)).alias("end_time"), F.array(host(1, 10), host(2, 7)).alias("event_memberships"),
    )
    payload = F.struct(
        F.concat(meeting, F.lit("/i/"), text(k)).alias("uri"), event.alias("scheduled_event"), stamp(created).alias("created_at"), stamp(later(created, age * 24)).alias("updated_at"), zone.alias("timezone"),
        F.when(k % 5 != 0, F.concat(F.lit(" A"), text(k), F.lit("@X.com"))).otherwise("  ").alias("email"), F.lit("{{name}}").alias("name"), F.when(age == 1, "moved").otherwise("active").alias("status"),
        (k % 2 == 0).alias("rescheduled"), F.struct(F.when(k % 2 == 0, "{{source}}").alias("utm_source"), F.lit(None).cast("string").alias("utm_campaign")).alias("tracking"),
    )
    return lines(o, payload=payload)


def _cancellations(spark, d) -> DataFrame:
    o, k, created = table(spark, d, "orders").where("o_orderstatus = 'F'"), F.col("o_orderkey"), F.col("o_orderdate")
    meeting = F.concat(F.lit("m/"), text(F.floor(k / 3)))
    at = F.when(k % 2 == 0, stamp(later(created, 48)))
    cancel = F.struct(at.alias("created_at"), F.lit("[no time]").alias("reason"), F.lit("Ann").alias("canceled_by"))
    return lines(o, payload=F.struct(F.concat(meeting, F.lit("/i/"), text(k)).alias("uri"), F.struct(meeting.alias("uri")).alias("scheduled_event"), cancel.alias("cancellation"), stamp(later(created, 48)).alias("updated_at")))


def _seed(spark) -> DataFrame:
    rows = [("1-URGENT", "paid", "true"), ("2-HIGH", "search", "true"), ("3-MEDIUM", "mail", "false")]
    return spark.createDataFrame([(f'{{"event_type": "{e}", "channel": "{c}", "is_paid": {p}}}',) for e, c, p in rows], "raw string")


@query(
    _BOOKED_SQL
    + """,
c AS (SELECT uri, min(created + INTERVAL 48 HOUR) AS gone FROM o WHERE st = 'F' GROUP BY 1)
SELECT f.uri AS scheduled_event_uri, '[Call] ' || m AS meeting_name, f.et AS event_type, coalesce(s.channel, 'other') AS channel, coalesce(s.paid, false) AS is_paid_channel, created AS created_at_utc,
  CAST(timezone('America/New_York', created AT TIME ZONE 'UTC') AS DATE) AS booking_date_est, start AS start_time_utc, start + INTERVAL 1 HOUR AS end_time_utc, tz AS invitee_timezone,
  coalesce(hour(timezone(tz, start AT TIME ZONE 'UTC')), -1) AS start_hour_invitee_local, coalesce(isodow(timezone(tz, start AT TIME ZONE 'UTC')), -1) AS start_dow_invitee_local,
  hour(timezone('America/New_York', start AT TIME ZONE 'UTC')) AS start_hour_business_est, isodow(timezone('America/New_York', start AT TIME ZONE 'UTC')) AS start_dow_business_est,
  tz IS NULL AS missing_invitee_timezone, n AS invitee_count, c.uri IS NOT NULL AS is_canceled, c.gone AS canceled_at, CASE WHEN k % 2 = 0 THEN '{{source}}' END AS utm_source
FROM f LEFT JOIN seed s ON s.et = f.et LEFT JOIN c ON c.uri = f.uri"""
)
def silver_fct_booking(spark, d):
    """A row a meeting of its first invitee, with default channel, pre-aggregated cancellations and invitees."""
    out = silver.fct_booking(CTX, {"calendly_booking": _booking_feed(spark, d), "calendly_cancellation": _cancellations(spark, d), "seed_channel_map": _seed(spark)})
    known = {c: F.coalesce(c, F.lit(-1).cast("long")) for c in ("start_hour_invitee_local", "start_dow_invitee_local")}
    return out.withColumns(known).drop("build_date", "meeting_status", "utm_campaign", "utm_medium")


@query(
    _BOOKED_SQL
    + """ SELECT invitee AS invitee_uri, uri AS scheduled_event_uri, CASE WHEN k % 5 <> 0 THEN ' A' || k || '@X.com' ELSE '  ' END AS email, CASE WHEN k % 5 <> 0 THEN 'a' || k || '@x.com' ELSE '' END AS email_normalized,
  k % 5 <> 0 AS has_email, '{{name}}' AS invitee_name, tz AS invitee_timezone, 'moved' AS invitee_status, created AS created_at_utc, CAST(timezone('America/New_York', created AT TIME ZONE 'UTC') AS DATE) AS booking_date_est,
  created + INTERVAL 24 HOUR AS updated_at_utc, k % 2 = 0 AS is_rescheduled, st = 'F' AS is_canceled, CASE WHEN st = 'F' THEN created + INTERVAL 48 HOUR END AS canceled_at,
  CASE WHEN st = 'F' THEN '[no time]' END AS cancel_reason, CASE WHEN st = 'F' THEN 'Ann' END AS canceled_by FROM o"""
)
def silver_fct_invitee(spark, d):
    """The latest of two states of each invitee, and the cancellation."""
    out = silver.fct_invitee(CTX, {"calendly_booking": _booking_feed(spark, d, copies=True), "calendly_cancellation": _cancellations(spark, d)})
    return out.drop("build_date", "first_name", "last_name", "questions_and_answers_json")


@query(
    _BOOKED_SQL
    + """,
h AS (SELECT *, unnest([1, 2]) AS j FROM f),
u AS (SELECT *, CASE j WHEN 1 THEN cust % 10 ELSE cust % 7 END AS r FROM h)
SELECT uri AS scheduled_event_uri, 'u' || j || '/' || r AS host_user_uri, 'h' || j || '.' || r || '@x.com' AS host_email_normalized, '[host ' || j || ']' AS host_name, coalesce(s.channel, 'other') AS channel,
  start AS start_time_utc, CAST(timezone('America/New_York', start AT TIME ZONE 'UTC') AS DATE) AS meeting_date_est, CAST(timezone('America/New_York', created AT TIME ZONE 'UTC') AS DATE) AS booking_date_est
FROM u LEFT JOIN seed s ON s.et = u.et WHERE r <> 0"""
)
def silver_fct_booking_host(spark, d):
    """Hosts unnested from the one row a meeting that stands for its invitees; members without a user go."""
    return silver.fct_booking_host(CTX, {"calendly_booking": _booking_feed(spark, d), "seed_channel_map": _seed(spark)}).drop("build_date", "host_email")


@query("""
SELECT 'p' || p_partkey AS hashed_id, CASE WHEN p_partkey % 3 = 0 THEN '[' || p_name || ']' ELSE p_name END AS media_name, p_type AS media_type, CAST(p_size * 10 AS DOUBLE) AS duration_seconds,
  round(p_size * 10 / 60.0::DOUBLE * 100.0, 0) / 100.0 AS duration_minutes, CASE WHEN p_partkey % 2 = 0 THEN '2024-01-03' ELSE '2024-01-02' END AS sourced_from_asof FROM part""")
def silver_dim_media(spark, d):
    """The newest of two or three snapshots of each medium; older ones have other names."""
    k = F.col("p_partkey")
    days = F.when(k % 2 == 0, F.array(*map(F.lit, ("2024-01-01", "2024-01-02", "2024-01-03")))).otherwise(F.array(*map(F.lit, ("2024-01-01", "2024-01-02"))))
    last = F.when(k % 2 == 0, "2024-01-03").otherwise("2024-01-02")
    p = table(spark, d, "part").withColumn("asof", F.explode(days))
    name = F.when(k % 3 == 0, F.concat(F.lit("["), "p_name", F.lit("]"))).otherwise(F.col("p_name"))
    feed = lines(p, "asof", hashed_id=F.concat(F.lit("p"), text(k)), name=F.when(F.col("asof") == last, name).otherwise("old"), type=F.col("p_type"), duration=F.col("p_size") * 10)
    return silver.dim_media(CTX, {"wistia_media": feed}).select("hashed_id", "media_name", "media_type", "duration_seconds", "duration_minutes", "sourced_from_asof")


@query("""
SELECT CAST(user_id AS VARCHAR) AS visitor_key, CAST(arg_max(event_id, ts) AS VARCHAR) AS org, arg_max_null(CASE WHEN event_type <> 'view' THEN '[' || event_type || ']' END, ts) AS country,
  CAST(arg_max(event_id % 2 = 0, ts) AS BOOLEAN) AS is_mobile FROM events GROUP BY user_id""")
def silver_dim_visitor_attributes(spark, d):
    """What the last session of each visitor says, nulls too."""
    agent = F.struct((F.col("event_id") % 2 == 0).alias("mobile"))
    country = F.when(F.col("event_type") != "view", F.concat(F.lit("["), "event_type", F.lit("]")))
    feed = lines(table(spark, d, "events"), visitor_key=text(F.col("user_id")), received_at=stamp(F.col("ts")), org=text(F.col("event_id")), country=country, user_agent_details=agent)
    return silver.dim_visitor(CTX, {"wistia_visitor_event": feed}).select("visitor_key", "org", "country", "is_mobile")


# ---- Gold figures that other queries leave out -------------------------------------------------------------------------


@query("""
WITH b AS (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE o_orderpriority END AS channel, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2),
s AS (SELECT day, channel, floor(amount) AS amount FROM (SELECT CAST(l_shipdate AS DATE) AS day, CASE l_returnflag WHEN 'A' THEN '1-URGENT' WHEN 'N' THEN '2-HIGH' ELSE '3-MEDIUM' END AS channel, l_extendedprice AS amount,
  row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE), l_returnflag ORDER BY l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem WHERE dayofmonth(l_shipdate) % 4 <> 0) WHERE rn = 1),
j AS (SELECT coalesce(b.day, s.day) AS metric_date, coalesce(b.channel, s.channel) AS channel, amount, coalesce(n, 0) AS n FROM b FULL OUTER JOIN s ON b.day = s.day AND b.channel = s.channel)
SELECT metric_date, channel, round(sum(amount) OVER w / nullif(CAST(sum(n) OVER w AS DOUBLE), 0) * 100.0, 0) / 100.0 AS cpb_7d_rolling FROM j
WINDOW w AS (PARTITION BY channel ORDER BY metric_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def cost_per_booking_weekly(spark, d):
    """The mart's own seven-row ratio of sums; whole amounts, so that the order of summing doesn't show."""
    whole = spend(spark, d).withColumn("spend", F.floor("spend").cast("double"))
    return gold.cpb_by_channel(CTX, {"fct_booking": bookings(spark, d), "fct_spend": whole}).select("metric_date", "channel", "cpb_7d_rolling")


@query("""
WITH b AS (SELECT event_id AS uri, CASE user_id % 3 WHEN 0 THEN 'paid' ELSE 'other' END AS channel, CAST(ts AS DATE) AS day, ts AS created, user_id AS mail FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id AS mail, ts, round(value) AS pv FROM events WHERE event_type = 'view'),
t AS (SELECT b.uri, avg(pv) AS pv FROM b JOIN v ON b.mail = v.mail AND v.ts < b.created AND v.ts >= b.created - INTERVAL 30 DAY GROUP BY 1)
SELECT channel, day AS booking_date, round(round(avg(pv) * 10000.0, 0) / 10000.0, 3) AS mean_of_means FROM b LEFT JOIN t ON t.uri = b.uri GROUP BY 1, 2""")
def funnel_mean_of_means(spark, d):
    """Mean over bookings of each booking's mean percentage, not over sessions."""
    e = table(spark, d, "events")
    buy, see = e.where("event_type = 'purchase'"), e.where("event_type = 'view'")
    b = buy.select(F.col("event_id").alias("scheduled_event_uri"), F.when(F.col("user_id") % 3 == 0, "paid").otherwise("other").alias("channel"), F.to_date("ts").alias("booking_date_est"), F.col("ts").alias("created_at_utc"))
    inv = buy.select(F.col("event_id").alias("scheduled_event_uri"), F.col("user_id").alias("email_normalized"))
    v = see.select(F.col("user_id").alias("email_normalized"), F.col("ts").alias("received_at_utc"), F.round("value").alias("percent_viewed"), F.lit(True).alias("is_identified"))
    out = gold.video_booking_funnel(CTX, {"fct_booking": b, "fct_invitee": inv, "fct_visitor_event": v})
    return out.select("channel", "booking_date", F.round("avg_percent_viewed", 3).alias("mean_of_means"))


# ---- landing -----------------------------------------------------------------------------------------------------------


@query("""
WITH e AS (SELECT event_id AS k, strftime(ts, '%Y-%m-%d') AS dt FROM events)
SELECT k, CASE WHEN k % 11 = 0 THEN 400 ELSE 200 END AS status, CASE WHEN k % 11 = 0 THEN NULL WHEN k % 3 = 0 THEN 'calendly_booking' WHEN k % 3 = 1 THEN 'calendly_cancellation' END AS feed,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 3 = 0 THEN 'calendly/bookings/dt=' || dt || '/calendly_event_i' || k || '.json' WHEN k % 3 = 1 THEN 'calendly/cancellations/dt=' || dt || '/calendly_cancel_i' || k || '.json' END AS key
FROM e WHERE NOT (k % 11 = 0 AND k % 3 = 2)""")
def booking_webhook_routes(spark, d):
    """Bodies of two routed kinds and of one that is accepted and ignored; each eleventh lacks what names it."""
    k = F.col("event_id")
    at = F.when(k % 11 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    uri = F.concat(F.lit("https://b/"), F.lit("m/i"), text(k), F.lit("/"))
    kind = F.when(k % 3 == 0, "invitee.created").when(k % 3 == 1, "invitee.canceled").otherwise("routing.created")
    payload = F.struct(F.when(k % 3 == 0, at).alias("created_at"), F.struct(F.when(k % 2 == 0, at).alias("created_at")).alias("cancellation"), at.alias("updated_at"), uri.alias("uri"))
    asked = table(spark, d, "events").where("not (event_id % 11 = 0 and event_id % 3 = 2)")
    body = F.to_json(F.struct(kind.alias("event"), payload.alias("payload")))
    return landing.booking_events(asked.select(k.alias("k"), body.alias("body"))).select("k", F.col("status_code").alias("status"), "feed", "key")


@query("SELECT event_id // 100 AS asof, event_id, value FROM events")
def spend_demux(spark, d):
    """Records of files of a hundred rows, one line each, values untouched."""
    row = F.struct("event_id", "value")
    files = table(spark, d, "events").groupBy(F.floor(F.col("event_id") / 100).alias("asof")).agg(F.to_json(F.collect_list(row)).alias("content")).withColumn("filename", text(F.col("asof")))
    out = json_fields(landing.demux(files), {"event_id": ("event_id",), "value": ("value",)}, keep=("asof",))
    return out.select("asof", F.col("event_id").cast("long").alias("event_id"), F.col("value").cast("double").alias("value"))


@query("""
SELECT c_custkey AS asof, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'old' END AS content_hash, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS pulled_at FROM customer""")
def manifest_record(spark, d):
    """A manifest with entries replaced for each third key and added for each sixth."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("asof"))
    known = c.where("asof % 6 <> 0").select("asof", F.lit("old").alias("content_hash"), F.lit(1).alias("pulled_at"))
    fresh = c.where("asof % 3 = 0").select("asof", F.lit("new").alias("content_hash"), F.lit(2).alias("pulled_at"))
    return landing.record(known, fresh)


@query("""
WITH a AS (SELECT c_custkey AS k, unnest(['2024-01-01', '2024-01-02']) AS dt FROM customer),
p AS (SELECT k, dt, '{"a":' || k || ',"b":"' || dt || '"}' || chr(10) AS x, '{"a":' || k + 1 || ',"b":"' || dt || '"}' || chr(10) AS y FROM a),
b AS (SELECT k, dt, CASE WHEN k % 4 = 0 THEN '' ELSE least(x, y) || greatest(x, y) END AS body FROM p)
SELECT 'wistia/visitor_events/dt=' || dt || '/c' || k || '.json' AS key, 'events#c' || k || '#' || dt AS pull_key, CASE WHEN k % 4 = 0 THEN 0 ELSE 2 END AS row_count, sha256(body) AS content_hash FROM b""")
def pulled_objects(spark, d):
    """An object for each medium and day asked for, keys sorted; a day without rows is an empty object."""
    k = F.col("c_custkey")
    media = table(spark, d, "customer").select(F.concat(F.lit("c"), text(k)).alias("hashed_id"), k)
    days = landing.window(spark, "2024-01-01", "2024-01-02")
    asked = landing.pulls(days, media)
    rows = media.where("c_custkey % 4 <> 0").crossJoin(days).withColumn("n", F.explode(F.array(F.lit(1), F.lit(0))))
    raw = F.concat(F.lit('{"b": "'), "dt", F.lit('", "a": '), text(k + F.col("n")), F.lit("}"))
    made = landing.pull_objects(asked, rows.select("hashed_id", "dt", raw.alias("raw")), "events")
    return made.select("key", "pull_key", "row_count", "content_hash")


# ---- notices -----------------------------------------------------------------------------------------------------------


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS event_id, CAST(o_custkey AS VARCHAR) AS lead_id, '*New Lead Alert*' || chr(10) || '*Name:* ' || CASE WHEN o_orderkey % 3 = 0 THEN '_not provided_' ELSE '[VIP] ' || o_orderkey END || chr(10) || '*Lead ID:* `' || o_custkey || '`' || chr(10)
  || '*Created Date:* ' || strftime(o_orderdate, '%Y-%m-%d') || chr(10) || '*Label:* ' || o_orderpriority || chr(10) || '*Email:* ' || CASE WHEN o_custkey % 4 = 0 THEN 'c' || o_custkey || '@x.com' ELSE '_pending_' END || chr(10)
  || '*Lead Owner:* ' || CASE WHEN o_custkey % 2 = 0 THEN 'owner' ELSE '_pending assignment_' END || chr(10) || '*Funnel:* _pending_' AS text FROM orders""")
def alert_texts(spark, d):
    """Notices of all orders as events, with owners for every second customer."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    data = F.struct(F.when(k % 3 != 0, F.concat(F.lit("[VIP] "), text(k))).otherwise("").alias("display_name"), F.col("o_orderpriority").alias("status_label"))
    event = F.struct(text(k).alias("id"), text(c).alias("lead_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_created"), data.alias("data"))
    claimed = json_fields(lines(table(spark, d, "orders"), event=event), alerts.EVENT_PATHS)
    who = table(spark, d, "customer").where("c_custkey % 2 = 0")
    raw = F.to_json(F.struct(F.lit("owner").alias("lead_owner"), F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("c"), text(F.col("c_custkey")), F.lit("@x.com"))).otherwise("").alias("lead_email")))
    owners = landing.owner_rows(who.select(text(F.col("c_custkey")).alias("lead_id"), raw.alias("raw")), 1)
    return alerts.notices(claimed, owners.select("lead_id", "lead_email", "lead_owner", "funnel"))


@query("""
WITH g AS (SELECT CAST(c_custkey AS VARCHAR) AS l FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 25 + 1 >= 24), n AS (SELECT count(*) AS n FROM g)
SELECT n, '*Owner reconciliation exhausted* — ' || n || ' lead(s) had no owner file after 24 hourly sweeps:' || chr(10) || (SELECT string_agg('• `' || l || '`', chr(10) ORDER BY l) FROM (SELECT l FROM g ORDER BY l LIMIT 20))
  || CASE WHEN n > 20 THEN chr(10) || '…and ' || n - 20 || ' more' ELSE '' END AS text FROM n WHERE n > 0""")
def escalation_text(spark, d):
    """What a sweep over all customers says of those given up: the first twenty by name."""
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("lead_id"), (F.col("c_custkey") % 25).cast("int").alias("retry_count"), F.lit("AWAITING").alias("status"))
    return alerts.escalation(alerts.sweep(c, c.where("cast(lead_id as long) % 4 = 0"), now=1))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS lead_id, CASE WHEN c_custkey % 2 = 0 THEN 'old' ELSE (SELECT min(CAST(o_orderkey AS VARCHAR)) FROM orders WHERE o_custkey = c_custkey) END AS event_id,
  CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 9 END AS first_seen_at, CASE WHEN c_custkey % 2 = 0 THEN 7 ELSE 0 END AS retry_count FROM customer WHERE c_custkey % 2 = 0 OR c_custkey IN (SELECT o_custkey FROM orders)""")
def worklist_add_missing(spark, d):
    """Leads without an owner join the worklist by their first event; those on it keep their counters."""
    on = table(spark, d, "customer").where("c_custkey % 2 = 0").select(
        text(F.col("c_custkey")).alias("lead_id"), F.lit("old").alias("event_id"), F.lit(1).cast("long").alias("first_seen_at"), F.lit(7).alias("retry_count"), F.lit("AWAITING").alias("status"), F.lit(None).cast("long").alias("last_attempt_at"),
    )
    misses = table(spark, d, "orders").select(text(F.col("o_custkey")).alias("lead_id"), text(F.col("o_orderkey")).alias("event_id"))
    return alerts.add_missing(on, misses, 9).select("lead_id", "event_id", "first_seen_at", "retry_count")
