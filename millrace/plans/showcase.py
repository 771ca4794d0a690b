"""Every relational operator as a named query over the star-schema tables, beside the SQL that says the same.

Roles: a meeting is an order (created at o_orderdate, channel o_orderpriority, cancelled if its status is F, invitee o_custkey);
a host is a line item's supplier; a spend file's row is a line item; viewing sessions are events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.dialect import asc, desc, first_match, hour_of, iso_dow, json_fields, known_zone, latest_by, local_date, local_ts, norm_email, not_blank, ratio, ratio_to, round_to, stem
from millrace.operators import gold, silver
from millrace.plans import serve
from millrace.operators.silver import BuildContext
from millrace.sources import landing
from millrace.streaming import alerts

CTX = BuildContext("showcase", "2024-02-01")
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- scans, projections, functions -------------------------------------------------------------------------------------


@query("SELECT event_id, user_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') IS NULL AS no_such FROM events")
def json_scalar_projection(spark, d):
    out = json_fields(table(spark, d, "events"), {"k": ("k",), "none": ("none",)}, raw="props", keep=("event_id", "user_id"))
    return out.select("event_id", "user_id", F.col("k").try_cast("long").alias("k"), F.col("none").isNull().alias("no_such"))


@query("""SELECT c_custkey, lower(regexp_replace(regexp_replace('  ' || c_name || CASE WHEN c_custkey % 3 = 0 THEN chr(9) ELSE ' ' END, '^\\s+', ''), '\\s+$', '')) AS email_normalized, c_custkey % 5 <> 0 AS has_email
FROM customer""")
def email_normalize(spark, d):
    c = table(spark, d, "customer")
    raw = F.concat(F.lit("  "), "c_name", F.when(F.col("c_custkey") % 3 == 0, "\t").otherwise(" "))
    blank = F.when(F.col("c_custkey") % 5 == 0, " \t ").otherwise(raw)
    return c.select("c_custkey", norm_email(raw).alias("email_normalized"), not_blank(blank).alias("has_email"))


@query("""SELECT page_id, nullif(regexp_extract(url, '/([^/?#]+)([?#].*)?$', 1), '') AS stem, nullif(regexp_extract(url, '/([^/]+)\\.json$', 1), '') AS json_stem FROM pages""")
def url_stem(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", first_match("url", r"/([^/?#]+)([?#].*)?$").alias("stem"), stem("url").alias("json_stem"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS open_price, o_totalprice >= 100000 AS is_large, nullif(o_orderpriority, '5-LOW') AS urgent, coalesce(nullif(o_orderpriority, '5-LOW'), 'other') AS channel,
CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' WHEN o_totalprice >= 100000 THEN 'LARGE' ELSE 'OPEN' END AS status FROM orders WHERE o_custkey IS NOT NULL""")
def projection_rules(spark, d):
    o = table(spark, d, "orders").where("o_custkey is not null")
    closed, large = F.col("o_orderstatus") == "F", F.col("o_totalprice") >= 100000
    urgent = F.nullif("o_orderpriority", F.lit("5-LOW"))
    return o.select("o_orderkey", F.when(~closed, F.col("o_totalprice")).alias("open_price"), large.alias("is_large"), urgent.alias("urgent"), F.coalesce(urgent, F.lit("other")).alias("channel"), F.when(closed, "CLOSED").when(large, "LARGE").otherwise("OPEN").alias("status"))


# ---- windows and deduplication -----------------------------------------------------------------------------------------

_LINE_ORDER = "l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST"


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(l_shipdate AS DATE) AS ship_date, source_count FROM (
SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS source_count FROM lineitem) WHERE rn = 1""")
def dedup_latest_row(spark, d):
    """Newest row of each key and how many there were, in one map-side combined aggregate instead of two windows."""
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    top = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max(F.struct(*order)).alias("t"), F.count("*").alias("source_count"))
    return top.select("l_orderkey", "l_linenumber", "t.l_partkey", "t.l_suppkey", "t.l_quantity", F.to_date("t.l_shipdate").alias("ship_date"), "source_count")


@query("SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS first_date, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC NULLS LAST, o_orderkey ASC NULLS LAST) AS rn FROM orders) WHERE rn = 1")
def first_row_per_group(spark, d):
    first = latest_by(table(spark, d, "orders"), ["o_custkey"], [asc("o_orderdate"), asc("o_orderkey")])
    return first.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("first_date"), "o_totalprice")


@query("""SELECT user_id, arg_max_null(event_type, ts) AS last_type, arg_max_null(CASE WHEN event_type = 'purchase' THEN value END, CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchase, min(ts) AS first_seen, max(ts) AS last_seen
FROM events GROUP BY user_id""")
def latest_attr_max_by(spark, d):
    buy = F.col("event_type") == "purchase"
    by = table(spark, d, "events").groupBy("user_id")
    return by.agg(F.max_by("event_type", "ts").alias("last_type"), F.max_by(F.when(buy, F.col("value")), F.when(buy, F.col("ts"))).alias("last_purchase"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


# ---- joins -------------------------------------------------------------------------------------------------------------

_MAP_SQL = "(VALUES ('1-URGENT', 'paid', true), ('2-HIGH', 'search', true), ('3-MEDIUM', 'mail', false)) AS m(p, channel, is_paid)"


def _seed_map(spark):
    return spark.createDataFrame([("1-URGENT", "paid", True), ("2-HIGH", "search", True), ("3-MEDIUM", "mail", False)], "o_orderpriority string, channel string, is_paid boolean")


@query(f"SELECT o_orderkey, coalesce(m.channel, 'other') AS channel, coalesce(m.is_paid, false) AS is_paid FROM orders LEFT JOIN {_MAP_SQL} ON o_orderpriority = m.p")
def left_join_default(spark, d):
    o = table(spark, d, "orders").join(_seed_map(spark), "o_orderpriority", "left")
    return o.select("o_orderkey", F.coalesce("channel", F.lit("other")).alias("channel"), F.coalesce("is_paid", F.lit(False)).alias("is_paid"))


@query("""SELECT o_orderkey, r.orderkey IS NOT NULL AS is_returned, r.first_return, coalesce(n.parts, 0) AS parts FROM orders
LEFT JOIN (SELECT l_orderkey AS orderkey, CAST(min(l_shipdate) AS DATE) AS first_return FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) r ON r.orderkey = o_orderkey
LEFT JOIN (SELECT l_orderkey AS orderkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1) n ON n.orderkey = o_orderkey""")
def left_join_preagg(spark, d):
    """Both sides of the aggregate come from one scan and one shuffle on the join's key."""
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    agg = li.agg(F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate"))).alias("r"), F.count_distinct("l_partkey").alias("parts"))
    o = table(spark, d, "orders").select("o_orderkey").join(agg, "o_orderkey", "left")
    return o.select("o_orderkey", F.col("r").isNotNull().alias("is_returned"), F.to_date("r").alias("first_return"), F.coalesce("parts", F.lit(0).cast("long")).alias("parts"))


@query("""SELECT t.n AS orders, coalesce(f.n, 0) AS on_day, f.top AS top_price, coalesce(z.n, 0) AS never FROM (SELECT count(*) AS n FROM orders) t
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1) f ON f.day = DATE '1996-03-05'
LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) z ON z.day = DATE '2050-01-01'""")
def const_predicate_left_join(spark, d):
    o = table(spark, d, "orders")
    day = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    at = lambda v, p: day.where(F.col("day") == F.lit(v).cast("date")).select(F.col("n").alias(f"{p}n"), F.col("top").alias(f"{p}top"))
    out = o.agg(F.count("*").alias("orders")).join(at("1996-03-05", "f"), F.lit(True), "left").join(at("2050-01-01", "z"), F.lit(True), "left")
    zero = F.lit(0).cast("long")
    return out.select("orders", F.coalesce("fn", zero).alias("on_day"), F.col("ftop").alias("top_price"), F.coalesce("zn", zero).alias("never"))


@query("""WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) SELECT o_orderkey, l_suppkey AS host, s_name AS host_name, coalesce(m.channel, 'other') AS channel
FROM l JOIN orders ON o_orderkey = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey """ + f"LEFT JOIN {_MAP_SQL} ON o_orderpriority = m.p WHERE l_suppkey % 7 <> 0")
def explode_bridge(spark, d):
    """A JSON array of hosts per meeting, unnested; members without a host are dropped after it."""
    host = F.to_json(F.collect_set(F.struct(F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey")).cast("string").alias("user"))))
    members = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(host.alias("members"))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority").join(members, "o_orderkey")
    rows = o.withColumn("m", F.explode(F.from_json("members", "array<struct<user:string>>"))).where("m.user is not null").select("o_orderkey", "o_orderpriority", F.col("m.user").cast("long").alias("host"))
    names = table(spark, d, "supplier").select(F.col("s_suppkey").alias("host"), F.col("s_name").alias("host_name"))
    return rows.join(names, "host", "left").join(_seed_map(spark), "o_orderpriority", "left").select("o_orderkey", "host", "host_name", F.coalesce("channel", F.lit("other")).alias("channel"))


@query("""WITH w AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'),
a AS (SELECT count(*) AS total, count(w.o_custkey) AS hit FROM customer LEFT JOIN w ON o_custkey = c_custkey)
SELECT total, hit, CASE WHEN total > 0 THEN round(CAST(hit AS DOUBLE) / total * 10000.0, 0) / 10000.0 END AS match_rate FROM a""")
def coverage_rates(spark, d):
    o = table(spark, d, "orders").where("o_orderdate >= timestamp'1997-01-01' and o_orderdate < timestamp'1997-07-01'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(True))
    agg = table(spark, d, "customer").join(o, "c_custkey", "left").agg(F.count("*").alias("total"), F.count("hit").alias("hit"))
    return agg.select("total", "hit", ratio_to("hit", "total", 4).alias("match_rate"))


# ---- the marts, by their own builders ----------------------------------------------------------------------------------

BOOKING = """booking AS (SELECT o_orderkey AS uri, CASE WHEN o_orderpriority = '5-LOW' THEN 'other' ELSE o_orderpriority END AS channel, o_orderpriority < '3' AS paid, CAST(o_orderdate AS DATE) AS day,
o_orderdate AS created, o_orderstatus = 'F' AS canceled, o_custkey AS cust FROM orders)"""
SPEND = """spend AS (SELECT day, channel, amount FROM (SELECT CAST(l_shipdate AS DATE) AS day, CASE l_returnflag WHEN 'A' THEN '1-URGENT' WHEN 'N' THEN '2-HIGH' ELSE '3-MEDIUM' END AS channel, l_extendedprice AS amount,
row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE), l_returnflag ORDER BY l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem WHERE dayofmonth(l_shipdate) % 4 <> 0) WHERE rn = 1)"""


def bookings(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    low = F.col("o_orderpriority") == "5-LOW"
    return o.select(
        F.col("o_orderkey").alias("scheduled_event_uri"), F.when(low, "other").otherwise(F.col("o_orderpriority")).alias("channel"), (F.col("o_orderpriority") < "3").alias("is_paid_channel"),
        F.to_date("o_orderdate").alias("booking_date_est"), F.col("o_orderdate").alias("created_at_utc"), (F.col("o_orderstatus") == "F").alias("is_canceled"), (F.col("o_custkey") % 3 + 1).alias("invitee_count"), F.col("o_custkey").alias("cust"),
    )


def spend(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem").where("dayofmonth(l_shipdate) % 4 <> 0")
    channel = F.when(F.col("l_returnflag") == "A", "1-URGENT").when(F.col("l_returnflag") == "N", "2-HIGH").otherwise("3-MEDIUM")
    by = li.groupBy(F.to_date("l_shipdate").alias("spend_date"), channel.alias("channel")).agg(F.max(F.struct("l_linenumber", "l_extendedprice")).alias("t"))
    return by.select("spend_date", "channel", F.col("t.l_extendedprice").alias("spend"))


@query(f"""WITH {BOOKING} SELECT day AS booking_date, channel, paid AS is_paid_channel, count(*) AS bookings, count(*) FILTER (NOT canceled) AS bookings_excl_canceled, count(*) FILTER (canceled) AS bookings_canceled,
CAST(sum(cust % 3 + 1) AS BIGINT) AS invitees, round(CAST(sum(cust % 3 + 1) AS DOUBLE) / count(*) * 100.0, 0) / 100.0 AS avg_invitees_per_booking FROM booking GROUP BY 1, 2, 3""")
def daily_calls_by_source(spark, d):
    return gold.daily_calls_by_source(CTX, {"fct_booking": bookings(spark, d)}).drop("build_date")


_CPB = f"""{BOOKING}, {SPEND}, b AS (SELECT day, channel, count(*) AS n, count(*) FILTER (NOT canceled) AS live FROM booking GROUP BY 1, 2), cov AS (SELECT DISTINCT day FROM spend),
j AS (SELECT coalesce(b.day, s.day) AS metric_date, coalesce(b.channel, s.channel) AS channel, s.amount AS spend, coalesce(n, 0) AS bookings, coalesce(live, 0) AS bookings_excl_canceled FROM b FULL OUTER JOIN spend s ON b.day = s.day AND b.channel = s.channel),
c AS (SELECT j.*, spend IS NULL AND cov.day IS NOT NULL AS is_genuine_zero_spend, spend IS NULL AND cov.day IS NULL AS is_spend_data_missing FROM j LEFT JOIN cov ON cov.day = j.metric_date)"""


@query(f"""WITH {_CPB} SELECT *, CASE WHEN is_spend_data_missing OR bookings = 0 THEN NULL ELSE round(spend / bookings * 100.0, 0) / 100.0 END AS cpb,
CASE WHEN is_spend_data_missing OR bookings_excl_canceled = 0 THEN NULL ELSE round(spend / bookings_excl_canceled * 100.0, 0) / 100.0 END AS cpb_excl_canceled FROM c""")
def cost_per_booking(spark, d):
    """Full outer join of two collapsed grains; the rolling figure has a query of its own."""
    return gold.cpb_by_channel(CTX, {"fct_booking": bookings(spark, d), "fct_spend": spend(spark, d)}).drop("build_date", "cpb_7d_rolling")


@query(f"""WITH {_CPB} SELECT metric_date, channel, round(sum(CAST(round(spend * 100) AS BIGINT)) OVER w / 100.0 / nullif(sum(bookings) OVER w, 0), 0) AS rolling FROM c
WINDOW w AS (PARTITION BY channel ORDER BY metric_date ASC NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def cost_per_booking_rolling(spark, d):
    """Seven-row ratio of sums, in cents so that the order of summing doesn't show."""
    rows = gold.cpb_by_channel(CTX, {"fct_booking": bookings(spark, d), "fct_spend": spend(spark, d)})
    w = Window.partitionBy("channel").orderBy(asc("metric_date")).rowsBetween(-6, 0)
    cents = F.sum(F.round(F.col("spend") * 100).cast("long")).over(w)
    return rows.select("metric_date", "channel", F.round(cents / F.lit(100.0) / F.nullif(F.sum("bookings").over(w).cast("double"), F.lit(0.0)), 0).alias("rolling"))


_TREND = "e AS (SELECT CAST(ts AS DATE) AS day, event_type, event_type IN ('view', 'click') AS paid, event_id % 4 = 0 AS canceled FROM events WHERE NOT (event_type = 'purchase' AND dayofmonth(ts) % 3 = 0))"


@query(f"""WITH {_TREND}, days AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM e)::TIMESTAMP, (SELECT max(day) FROM e)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day), ch AS (SELECT DISTINCT event_type, paid FROM e),
a AS (SELECT day, event_type, count(*) AS n, count(*) FILTER (NOT canceled) AS live FROM e GROUP BY 1, 2),
x AS (SELECT days.day AS booking_date, ch.event_type AS channel, ch.paid AS is_paid_channel, coalesce(n, 0) AS bookings, coalesce(live, 0) AS bookings_excl_canceled FROM days CROSS JOIN ch LEFT JOIN a ON a.day = days.day AND a.event_type = ch.event_type)
SELECT *, CAST(date_trunc('week', booking_date) AS DATE) AS booking_week, CAST(sum(bookings) OVER (PARTITION BY channel ORDER BY booking_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS bookings_7d_rolling,
CAST(sum(bookings) OVER (PARTITION BY channel ORDER BY booking_date) AS BIGINT) AS bookings_cumulative FROM x""")
def dense_trend(spark, d):
    e = table(spark, d, "events").where("not (event_type = 'purchase' and dayofmonth(ts) % 3 = 0)")
    b = e.select(F.to_date("ts").alias("booking_date_est"), F.col("event_type").alias("channel"), F.col("event_type").isin("view", "click").alias("is_paid_channel"), (F.col("event_id") % 4 == 0).alias("is_canceled"))
    return gold.bookings_trend(CTX, {"fct_booking": b}).drop("build_date")


@query(f"""WITH {_CPB}, a AS (SELECT channel, CAST(sum(bookings) AS BIGINT) AS total_bookings, CAST(sum(bookings_excl_canceled) AS BIGINT) AS total_bookings_excl_canceled, sum(CASE WHEN NOT is_spend_data_missing THEN spend END) AS s,
count(*) AS days_observed, count(*) FILTER (is_spend_data_missing) AS days_spend_missing, count(*) FILTER (is_genuine_zero_spend) AS days_zero_spend, min(metric_date) AS first_date, max(metric_date) AS last_date FROM c GROUP BY channel)
SELECT channel, total_bookings, total_bookings_excl_canceled, round(s * 100.0, 0) / 100.0 AS total_spend, round(s / nullif(total_bookings, 0) * 100.0, 0) / 100.0 AS cpb, round(s / nullif(total_bookings_excl_canceled, 0) * 100.0, 0) / 100.0 AS cpb_excl_canceled,
rank() OVER (ORDER BY total_bookings DESC NULLS LAST) AS rank_by_volume, rank() OVER (ORDER BY s / nullif(total_bookings, 0) ASC NULLS LAST) AS rank_by_efficiency, days_observed, days_spend_missing, days_zero_spend,
round(CAST(days_observed - days_spend_missing AS DOUBLE) / days_observed * 10000.0, 0) / 10000.0 AS spend_coverage_rate, first_date, last_date FROM a""")
def channel_leaderboard(spark, d):
    cpb = gold.cpb_by_channel(CTX, {"fct_booking": bookings(spark, d), "fct_spend": spend(spark, d)})
    return gold.channel_attribution(CTX, {}, cpb).withColumn("total_spend", round_to("total_spend", 2)).drop("build_date")


_ZONES = "(VALUES (0, 'Asia/Kolkata'), (1, 'America/Los_Angeles'), (2, 'Europe/Berlin'), (3, CAST(NULL AS VARCHAR))) AS z(k, tz)"


@query(f"""WITH b AS (SELECT event_type AS channel, event_id % 5 = 0 AS canceled, z.tz, timezone(z.tz, ts AT TIME ZONE 'UTC') AS l, timezone('America/New_York', ts AT TIME ZONE 'UTC') AS n FROM events JOIN {_ZONES} ON z.k = user_id % 4),
u AS (SELECT 'customer_local' AS perspective, hour(l) AS hour_of_day, isodow(l) AS day_of_week, channel, count(*) AS bookings, count(*) FILTER (NOT canceled) AS bookings_excl_canceled FROM b WHERE tz IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'business_est', hour(n), isodow(n), channel, count(*), count(*) FILTER (NOT canceled) FROM b GROUP BY ALL),
c AS (SELECT count(*) AS total, count(*) FILTER (tz IS NULL) AS lost FROM b)
SELECT u.*, round(bookings / CAST(sum(bookings) OVER (PARTITION BY perspective) AS DOUBLE) * 10000.0, 0) / 10000.0 AS share_of_perspective,
CASE WHEN perspective = 'customer_local' THEN round(CAST(total - lost AS DOUBLE) / total * 10000.0, 0) / 10000.0 ELSE 1.0::DOUBLE END AS perspective_coverage_rate FROM u CROSS JOIN c""")
def time_slots_two_perspectives(spark, d):
    zone = F.get(F.array(F.lit("Asia/Kolkata"), F.lit("America/Los_Angeles"), F.lit("Europe/Berlin"), F.lit(None).cast("string")), (F.col("user_id") % 4).cast("int"))
    e = table(spark, d, "events").withColumn("tz", zone)
    there, here = local_ts("ts", known_zone("tz")), local_ts("ts")
    b = e.select(
        F.col("event_type").alias("channel"), (F.col("event_id") % 5 == 0).alias("is_canceled"), F.col("tz").isNull().alias("missing_invitee_timezone"), hour_of(there).alias("start_hour_invitee_local"), iso_dow(there).alias("start_dow_invitee_local"),
        hour_of(here).alias("start_hour_business_est"), iso_dow(here).alias("start_dow_business_est"),
    )
    return gold.booking_time_slots(CTX, {"fct_booking": b}).drop("build_date")


@query("""WITH h AS (SELECT l_suppkey AS host, s_name, CAST(o_orderdate AS DATE) AS day FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey), w AS (SELECT min(day) AS lo, max(day) AS hi FROM h),
p AS (SELECT host, max(s_name) AS host_name, count(*) AS n, count(DISTINCT day) AS days, count(DISTINCT date_trunc('week', day)) AS weeks, min(day) AS a, max(day) AS b FROM h GROUP BY host),
x AS (SELECT *, greatest(1.0::DOUBLE, date_diff('day', a, hi) / 7.0::DOUBLE) AS tenure, date_diff('day', lo, hi) / 7.0::DOUBLE AS win FROM p CROSS JOIN w)
SELECT host AS host_user_uri, host_name, n AS total_meetings, days AS days_with_meetings, weeks AS active_weeks, a AS first_meeting_date, b AS last_meeting_date, round(tenure * 100.0, 0) / 100.0 AS tenure_weeks, round(win * 100.0, 0) / 100.0 AS window_weeks,
round(n / tenure * 100.0, 0) / 100.0 AS avg_meetings_per_week, round(n / nullif(win, 0) * 100.0, 0) / 100.0 AS avg_per_week_naive_window, round(CAST(n AS DOUBLE) / nullif(weeks, 0) * 100.0, 0) / 100.0 AS avg_per_active_week, rank() OVER (ORDER BY n / tenure DESC NULLS LAST) AS rank_by_load FROM x""")
def host_load(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("meeting_date_est"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("host_name"))
    h = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").join(o, "l_orderkey").join(s, "l_suppkey").withColumn("host_email", F.lit(None).cast("string")).withColumnRenamed("l_suppkey", "host_user_uri")
    return gold.meeting_load_by_employee(CTX, {"fct_booking_host": h}).drop("build_date", "host_email", "tenure_is_proxied", "tenure_caveat")


@query("""WITH s AS (SELECT user_id % 10 AS hashed_id, CAST(ts AS DATE) AS stat_date, count(*) FILTER (event_type = 'view') AS load_count, count(*) FILTER (event_type = 'click') AS play_count, count(*) FILTER (event_type = 'purchase') * 0.25::DOUBLE AS hours_watched FROM events GROUP BY 1, 2)
SELECT s.hashed_id, CASE WHEN s.hashed_id < 7 THEN 'media ' || s.hashed_id END AS media_name, stat_date, load_count, play_count, hours_watched, load_count = 0 AND play_count = 0 AS is_zero_activity_day,
CASE WHEN load_count > 0 THEN round(CAST(play_count AS DOUBLE) / load_count * 10000.0, 0) / 10000.0 END AS play_rate, round(CAST(sum(play_count) OVER w AS DOUBLE) / nullif(sum(load_count) OVER w, 0) * 10000.0, 0) / 10000.0 AS play_rate_7d,
round(CAST(sum(play_count) OVER t AS DOUBLE) / nullif(sum(load_count) OVER t, 0) * 10000.0, 0) / 10000.0 AS play_rate_to_date, CAST(sum(play_count) OVER t AS BIGINT) AS plays_cumulative, CAST(sum(load_count) OVER t AS BIGINT) AS loads_cumulative,
CASE WHEN play_count > 0 THEN round(hours_watched * 60.0 / play_count * 100.0, 0) / 100.0 END AS avg_minutes_per_play FROM s WINDOW t AS (PARTITION BY s.hashed_id ORDER BY stat_date), w AS (PARTITION BY s.hashed_id ORDER BY stat_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def media_engagement(spark, d):
    e = table(spark, d, "events").groupBy((F.col("user_id") % 10).alias("hashed_id"), F.to_date("ts").alias("stat_date"))
    of = lambda t: F.count_if(F.col("event_type") == t)
    stats = e.agg(of("view").alias("load_count"), of("click").alias("play_count"), (of("purchase") * F.lit(0.25)).alias("hours_watched")).withColumn("is_zero_activity_day", (F.col("load_count") == 0) & (F.col("play_count") == 0))
    media = spark.range(7).select(F.col("id").alias("hashed_id"), F.concat(F.lit("media "), "id").alias("media_name"), F.lit(1.0).alias("duration_minutes"))
    return gold.media_engagement(CTX, {"fct_media_daily_stats": stats.withColumn("build_date", F.lit(None)), "dim_media": media}).drop("build_date", "duration_minutes")


@query("""WITH b AS (SELECT event_id AS uri, CASE user_id % 3 WHEN 0 THEN 'paid' ELSE 'other' END AS channel, CAST(ts AS DATE) AS day, ts AS created, CASE WHEN user_id % 5 <> 0 THEN user_id END AS mail FROM events WHERE event_type = 'purchase'),
v AS (SELECT CASE WHEN user_id % 4 <> 0 THEN user_id END AS mail, ts, round(value) AS pv FROM events WHERE event_type = 'view'),
t AS (SELECT b.uri, count(*) AS k, CAST(sum(pv) AS BIGINT) AS pv FROM b JOIN v ON b.mail = v.mail AND v.ts < b.created AND v.ts >= b.created - INTERVAL 30 DAY GROUP BY 1),
g AS (SELECT channel, day, count(*) AS bookings, count(mail) AS bookings_with_email, count(k) AS m, coalesce(sum(k), 0) AS sess FROM b LEFT JOIN t ON t.uri = b.uri GROUP BY 1, 2), c AS (SELECT count(*) AS n, count(mail) AS ident FROM v)
SELECT channel, day AS booking_date, bookings, bookings_with_email, m AS bookings_with_prior_video, round(CAST(m AS DOUBLE) / bookings * 10000.0, 0) / 10000.0 AS video_touch_rate_floor, CAST(sess AS BIGINT) AS prior_video_sessions,
round(CAST(bookings_with_email AS DOUBLE) / bookings * 10000.0, 0) / 10000.0 AS booking_email_coverage, round(CAST(ident AS DOUBLE) / n * 10000.0, 0) / 10000.0 AS video_identification_rate, ident = 0 AS not_measurable FROM g CROSS JOIN c""")
def prior_touch_funnel(spark, d):
    e = table(spark, d, "events")
    buy, see = e.where("event_type = 'purchase'"), e.where("event_type = 'view'")
    b = buy.select(F.col("event_id").alias("scheduled_event_uri"), F.when(F.col("user_id") % 3 == 0, "paid").otherwise("other").alias("channel"), F.to_date("ts").alias("booking_date_est"), F.col("ts").alias("created_at_utc"))
    inv = buy.select(F.col("event_id").alias("scheduled_event_uri"), F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("email_normalized"))
    mail = F.when(F.col("user_id") % 4 != 0, F.col("user_id"))
    v = see.select(mail.alias("email_normalized"), F.col("ts").alias("received_at_utc"), F.round("value").alias("percent_viewed"), mail.isNotNull().alias("is_identified"))
    out = gold.video_booking_funnel(CTX, {"fct_booking": b, "fct_invitee": inv, "fct_visitor_event": v})
    return out.withColumn("not_measurable", F.col("interpretation") == gold.NOT_MEASURABLE).drop("build_date", "interpretation", "avg_percent_viewed")


@query("""WITH b AS (SELECT event_id AS uri, ts AS created, user_id FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, CAST(round(value * 100) AS BIGINT) AS pv FROM events WHERE event_type = 'view'),
t AS (SELECT uri, count(*) AS sessions, sum(pv) AS s, max(pv) AS max_pv FROM b JOIN v ON b.user_id = v.user_id AND v.ts < created AND v.ts >= created - INTERVAL 7 DAY GROUP BY 1) SELECT uri, sessions, CAST(s AS DOUBLE) / sessions AS mean_pv, max_pv FROM t""")
def temporal_range_join(spark, d):
    """Each purchase with the views of the seven days before it, by the join that the funnel mart makes."""
    e = table(spark, d, "events")
    seen = e.where("event_type = 'view'").select(F.col("user_id").alias("email_normalized"), F.col("ts").alias("received_at_utc"), F.round(F.col("value") * 100).cast("long").alias("percent_viewed"))
    bought = e.where("event_type = 'purchase'").select(F.col("event_id").alias("scheduled_event_uri"), F.col("ts").alias("created_at_utc"), F.col("user_id").alias("email_normalized"))
    return gold.prior_touch(bought, seen, 7).select(F.col("scheduled_event_uri").alias("uri"), "sessions", F.col("avg_pv").alias("mean_pv"), F.col("max_pv").alias("max_pv"))


# ---- view-level aggregation, sorting, set operations --------------------------------------------------------------------


@query(f"""WITH {_CPB}, a AS (SELECT channel, sum(bookings) AS n, sum(CASE WHEN NOT is_spend_data_missing THEN spend END) AS s, count(*) AS obs, count(*) FILTER (is_spend_data_missing) AS lost FROM c GROUP BY channel)
SELECT CAST(sum(n) AS BIGINT) AS bookings, round(sum(s) / nullif(sum(n), 0) * 100.0, 0) / 100.0 AS blended_cpb, round(CAST(sum(obs - lost) FILTER (s IS NOT NULL) AS DOUBLE) / nullif(sum(obs) FILTER (s IS NOT NULL), 0) * 10000.0, 0) / 10000.0 AS spend_coverage FROM a""")
def dashboard_overview(spark, d):
    cpb = gold.cpb_by_channel(CTX, {"fct_booking": bookings(spark, d), "fct_spend": spend(spark, d)})
    out = serve.overview(gold.channel_attribution(CTX, {}, cpb))
    return out.select("bookings", round_to("blended_cpb", 2).alias("blended_cpb"), round_to("spend_coverage", 4).alias("spend_coverage"))


@query("SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10")
def serving_top_n(spark, d):
    top = serve.pick(table(spark, d, "orders"), "o_orderstatus = 'O'", ["o_totalprice DESC", "o_orderkey"], 10)
    return top.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))


@query("""SELECT o_orderpriority AS channel, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 20""")
def top_20_per_channel(spark, d):
    w = Window.partitionBy("o_orderpriority").orderBy(desc("o_totalprice"), asc("o_orderkey"))
    return table(spark, d, "orders").withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 20").select(F.col("o_orderpriority").alias("channel"), "o_orderkey", "o_totalprice", "rank")


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'new' WHEN doc_id % 7 = 0 THEN 'corrected' ELSE 'unchanged' END AS state, sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL""")
def manifest_diff(spark, d):
    """Content hashes against a manifest that lacks each third document and holds another hash for each seventh."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"))
    known = docs.where("doc_id % 3 <> 0").select(F.col("doc_id").alias("asof"), F.when(F.col("doc_id") % 7 == 0, "stale").otherwise(F.col("content_hash")).alias("content_hash"))
    files = docs.select(F.col("doc_id").alias("asof"), F.lit("[]").alias("content"), "content_hash")
    return landing.classify(files, known).select(F.col("asof").alias("doc_id"), "state", "content_hash")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def manifest_missing(spark, d):
    ids = table(spark, d, "documents").select(F.col("doc_id").alias("asof"))
    return landing.still_missing(ids, ids.where("asof % 3 <> 0")).select(F.col("asof").alias("doc_id"))


@query("""SELECT CAST(event_id // 1000 AS VARCHAR) AS asof, count(*) AS row_count, strftime(min(ts), '%Y-%m-%d') AS date_min, strftime(max(ts), '%Y-%m-%d') AS date_max, count(DISTINCT CAST(ts AS DATE)) AS distinct_dates, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS channels
FROM events GROUP BY 1""")
def file_profile(spark, d):
    """Files of a thousand events, as JSON arrays; what the manifest records of each."""
    row = F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_type").alias("channel"))
    files = table(spark, d, "events").groupBy(F.floor(F.col("event_id") / 1000).cast("string").alias("asof")).agg(F.to_json(F.collect_list(row)).alias("content"))
    return landing.profile(files.withColumn("filename", F.col("asof"))).drop("filename")


@query("""SELECT event_id, 'crm/events/dt=' || strftime(ts, '%Y-%m-%d') || '/crm_event_' || event_id || '.json' AS key, 200 AS status FROM events WHERE event_id % 7 <> 0
UNION ALL SELECT event_id, NULL, 400 FROM events WHERE event_id % 7 = 0""")
def webhook_keys(spark, d):
    """Landing keys of CRM webhook bodies; each seventh lacks its date and is refused."""
    e = table(spark, d, "events")
    at = F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    body = F.to_json(F.struct(F.struct(F.col("event_id").cast("string").alias("id"), at.alias("date_created")).alias("event")))
    return landing.crm_events(e.select("event_id", body.alias("body"))).select("event_id", "key", F.col("status_code").alias("status"))


@query("SELECT count(*) AS events, count(*) FILTER (event_type = 'purchase') AS identified, CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) / nullif(count(*), 0) AS identification_rate FROM events")
def identification_rate(spark, d):
    mail = F.when(F.col("event_type") == "purchase", "a@x").otherwise(" ")
    return landing.identification(table(spark, d, "events").select(mail.alias("email")))


# ---- Silver tables from JSON lines made of the star tables -------------------------------------------------------------


def lines(df: DataFrame, *also: str, **fields) -> DataFrame:
    """Bronze lines: raw, and the columns named."""
    return df.select(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("raw"), *also)


@query("""WITH r AS (SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag AS channel, l_extendedprice AS spend, strftime(CAST(l_shipdate AS DATE) + l_linenumber, '%Y-%m-%d') AS published FROM lineitem)
SELECT day AS spend_date, channel, spend, channel <> 'R' AS is_paid_channel, published AS sourced_from_asof, n AS source_file_count FROM (
SELECT *, row_number() OVER (PARTITION BY day, channel ORDER BY published DESC, spend DESC) AS rn, count(*) OVER (PARTITION BY day, channel) AS n FROM r) WHERE rn = 1""")
def silver_fct_spend(spark, d):
    li = table(spark, d, "lineitem").withColumn("asof", F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber")).cast("string"))
    feed = lines(li, "asof", date=F.to_date("l_shipdate").cast("string"), channel=F.col("l_returnflag"), spend=F.col("l_extendedprice"))
    seed = spark.createDataFrame([('{"event_type": "a", "channel": "R", "is_paid": false}',), ('{"event_type": "b", "channel": "R", "is_paid": false}',)], "raw string")
    return silver.fct_spend(CTX, {"calendly_spend": feed, "seed_channel_map": seed}).drop("build_date")


@query("""WITH r AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(ts AS DATE) + CAST(event_id % 3 AS INTEGER) AS dt, user_id % 4 AS loads, event_id % 5 AS plays, value FROM events)
SELECT event_type AS hashed_id, day AS stat_date, loads AS load_count, plays AS play_count, value AS hours_watched, loads = 0 AND plays = 0 AS is_zero_activity_day FROM (
SELECT *, row_number() OVER (PARTITION BY event_type, day ORDER BY dt DESC, loads DESC, plays DESC, CAST(value AS VARCHAR) DESC) AS rn FROM r) WHERE rn = 1""")
def silver_fct_media_daily_stats(spark, d):
    e = table(spark, d, "events").withColumn("dt", F.date_add(F.to_date("ts"), (F.col("event_id") % 3).cast("int")).cast("string")).withColumn("source_path", F.concat(F.lit("/feed/"), "event_type", F.lit(".json")))
    feed = lines(e, "dt", "source_path", date=F.to_date("ts").cast("string"), load_count=F.col("user_id") % 4, play_count=F.col("event_id") % 5, hours_watched=F.col("value").cast("string"))
    return silver.fct_media_daily_stats(CTX, {"wistia_media_stats": feed}).drop("build_date")


_STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


@query("""SELECT CAST(user_id AS VARCHAR) AS visitor_key, 'u' || user_id || '@x.com' AS email_normalized, bool_or(event_type = 'purchase') AS is_identified, CAST(min(ts) AS DATE) AS first_seen, CAST(max(ts) AS DATE) AS last_seen
FROM events GROUP BY user_id HAVING bool_or(event_type = 'purchase') UNION ALL
SELECT CAST(user_id AS VARCHAR), NULL, false, CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) FROM events GROUP BY user_id HAVING NOT bool_or(event_type = 'purchase')""")
def silver_dim_visitor(spark, d):
    """An address once given survives later anonymous visits."""
    mail = F.when(F.col("event_type") == "purchase", F.concat(F.lit(" U"), F.col("user_id").cast("string"), F.lit("@X.com\t")))
    feed = lines(table(spark, d, "events"), visitor_key=F.col("user_id").cast("string"), received_at=F.date_format("ts", _STAMP), email=mail)
    out = silver.dim_visitor(CTX, {"wistia_visitor_event": feed})
    return out.select("visitor_key", "email_normalized", "is_identified", F.to_date("first_seen_at").alias("first_seen"), F.to_date("last_seen_at").alias("last_seen"))


@query("""SELECT CAST(event_id AS VARCHAR) AS event_key, event_type AS hashed_id, CAST(timezone('America/New_York', ts AT TIME ZONE 'UTC') AS DATE) AS event_date_est, value AS percent_viewed, value >= 0.25 AS watched_quarter, value >= 0.5 AS watched_half FROM events""")
def silver_fct_visitor_event(spark, d):
    """Each session lands twice, on its day and on the next; one row stays."""
    e = table(spark, d, "events").withColumn("dt", F.explode(F.transform(F.array(F.lit(0), F.lit(1)), lambda k: F.date_add(F.to_date("ts"), k).cast("string"))))
    feed = lines(e, "dt", event_key=F.col("event_id").cast("string"), media_id=F.col("event_type"), received_at=F.date_format("ts", _STAMP), percent_viewed=F.col("value").cast("string"))
    return silver.fct_visitor_event(CTX, {"wistia_visitor_event": feed}).select("event_key", "hashed_id", "event_date_est", "percent_viewed", "watched_quarter", "watched_half")


@query("""SELECT event_id, timezone('America/New_York', ts AT TIME ZONE 'UTC') AS local_ts, CAST(timezone('America/New_York', ts AT TIME ZONE 'UTC') AS DATE) AS local_date, CAST(date_trunc('week', ts) AS DATE) AS week, isodow(ts) AS dow, hour(ts) AS hour FROM events""")
def zone_functions(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", local_ts("ts").alias("local_ts"), local_date("ts").alias("local_date"), F.trunc("ts", "week").alias("week"), iso_dow("ts").alias("dow"), hour_of("ts").alias("hour"))


# ---- stateful cores as batch -------------------------------------------------------------------------------------------


@query("""SELECT event_id, epoch_us(min(ts)) AS claimed_at, count(*) AS deliveries FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 2 = 0) GROUP BY 1 HAVING event_id % 10 <> 0""")
def claim_dedup_core(spark, d):
    """Events delivered once or twice are claimed once; every tenth was sent before and isn't claimed again."""
    e = table(spark, d, "events").select(F.col("event_id").cast("string").alias("event_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    sent = e.where("cast(event_id as long) % 10 = 0").select("event_id", F.lit("SENT").alias("status"), F.lit(0).cast("long").alias("claimed_at"))
    claimed = alerts.claim(e.union(e.where("cast(event_id as long) % 2 = 0")), sent, lease=120)
    return claimed.select(F.col("event_id").cast("long").alias("event_id"), "claimed_at", "deliveries")


@query("""SELECT c_custkey AS lead_id, CASE WHEN c_custkey % 4 = 0 THEN 'PROMOTED' WHEN c_custkey % 25 + 1 >= 24 THEN 'EXHAUSTED' ELSE 'AWAITING' END AS status, CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 25 ELSE c_custkey % 25 + 1 END AS retry_count FROM customer""")
def sweep_core(spark, d):
    """One sweep over a worklist: an owner found promotes, a miss counts, the last miss gives up."""
    c = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("lead_id"), (F.col("c_custkey") % 25).cast("int").alias("retry_count"), F.lit("AWAITING").alias("status"))
    owners = c.where("cast(lead_id as long) % 4 = 0").select("lead_id", F.lit("someone").alias("lead_owner"))
    out = alerts.sweep(c, owners, now=1000)
    return out.select(F.col("lead_id").cast("long").alias("lead_id"), F.col("next_status").alias("status"), F.col("next_count").cast("long").alias("retry_count"))
