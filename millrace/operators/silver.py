"""Silver: one deduplicated, typed table for each grain. Builders take Bronze by name and a context; full recompute each time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dialect import (
    asc, desc, hour_of, iso_dow, iso_ts, json_fields, known_zone, latest_by, local_date, local_ts, norm_email, not_blank, ratio_to, round_to, stem,
)

Tables = dict[str, DataFrame]

#: Fixed value: the text that goes with the rates.
COVERAGE_CAVEAT = "unmatched leads skew recent - owner assignment has not landed yet"
LATE_CHANNEL = "other"


@dataclass(frozen=True)
class BuildContext:
    """What a build is for: its id, its as-of date (YYYY-MM-DD) and the key of the CRM's funnel field."""

    build_id: str
    asof: str
    funnel_field_id: str = ""


def _dated(df: DataFrame, ctx: BuildContext) -> DataFrame:
    return df.withColumn("build_date", F.lit(ctx.asof).cast("date"))


def _channels(bronze: Tables) -> DataFrame:
    """Seed map event type -> channel, is_paid; small by nature, so Spark broadcasts it by its measured size."""
    return json_fields(bronze["seed_channel_map"], {"event_type": ("event_type",), "map_channel": ("channel",), "map_paid": ("is_paid",)}).withColumn("map_paid", F.col("map_paid").cast("boolean"))


def dim_lead(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """Latest event of each lead, with the owner snapshot of the build's date."""
    data = ("event", "data")
    paths = {
        "event_id": ("event", "id"), "lead_id": ("event", "lead_id"), "last_action": ("event", "action"), "updated": ("event", "date_updated"),
        "display_name": (*data, "display_name"), "status_label": (*data, "status_label"), "created_text": (*data, "date_created"), "updated_text": (*data, "date_updated"),
    }
    if ctx.funnel_field_id:
        paths["funnel"] = (*data, ctx.funnel_field_id)
    events = json_fields(bronze["crm_event"], paths).where("lead_id is not null")
    if not ctx.funnel_field_id:
        events = events.withColumn("funnel", F.lit(None).cast("string"))
    latest = latest_by(events.withColumn("__t", iso_ts("updated")), ["lead_id"], [desc("__t"), desc("event_id")])
    owner = json_fields(bronze["lead_owner"].where(F.col("asof") == ctx.asof), {"lead_id": ("lead_id",), "lead_owner": ("lead_owner",), "lead_email": ("lead_email",)})
    status = F.when(F.col("lead_email").isNotNull(), "ENRICHED").when(F.col("lead_owner").isNotNull(), "OWNER_ONLY").otherwise("AWAITING_OWNER")
    out = latest.join(owner, "lead_id", "left").select(
        "lead_id", "display_name", "status_label", "funnel", "last_action", "lead_owner", "lead_email",
        norm_email("lead_email").alias("lead_email_normalized"),
        iso_ts("created_text").alias("lead_created_at"), iso_ts("updated_text").alias("lead_updated_at"),
        F.col("lead_email").isNotNull().alias("has_email"), F.col("lead_owner").isNotNull().alias("has_owner"),
        status.alias("enrichment_status"), F.col("event_id").alias("source_event_id"),
    )
    return _dated(out, ctx)


def dq_lead_coverage(ctx: BuildContext, bronze: Tables, dim_lead: DataFrame) -> DataFrame:
    """One row: how far this build's leads are covered, with the worklist and owner cache of its date."""
    leads = dim_lead.agg(F.count("*").alias("total"), F.count_if("has_email").alias("emails"), F.count_if("has_owner").alias("owners"))
    history = bronze["lead_owner"].where(F.col("asof") == ctx.asof).groupBy("asof").agg(F.count("*").alias("cache")).drop("asof")
    rows = json_fields(bronze["awaiting_owner"].where(F.col("asof") == ctx.asof), {"status": ("status",), "retries": ("retry_count",)}, keep=("asof",))
    awaiting = rows.groupBy("asof").agg(F.count_if(F.col("status") == "AWAITING").alias("open"), F.count_if(F.col("status") == "EXHAUSTED").alias("given_up"), F.max(F.col("retries").cast("int")).alias("max_retry_count")).drop("asof")
    joined = leads.join(awaiting, F.lit(True), "left").join(history, F.lit(True), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        F.lit(ctx.asof).cast("date").alias("build_date"), F.col("total").alias("total_leads"), F.col("emails").alias("leads_with_email"), F.col("owners").alias("leads_with_owner"),
        ratio_to("emails", "total", 4).alias("email_match_rate"), ratio_to("owners", "total", 4).alias("owner_match_rate"),
        F.coalesce("open", zero).alias("awaiting_owner_open"), F.coalesce("given_up", zero).alias("awaiting_owner_exhausted"), "max_retry_count",
        F.coalesce("cache", zero).alias("owner_cache_size"), F.lit(COVERAGE_CAVEAT).alias("coverage_caveat"),
    )


_MEETING = ("payload", "scheduled_event")


def fct_booking(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """One row a meeting: its first invitee's attributes, how many invitees it has and whether any of them cancelled."""
    paths = {
        "scheduled_event_uri": (*_MEETING, "uri"), "invitee_uri": ("payload", "uri"), "meeting_name": (*_MEETING, "name"), "meeting_status": (*_MEETING, "status"),
        "event_type": (*_MEETING, "event_type"), "created": ("payload", "created_at"), "start": (*_MEETING, "start_time"), "end": (*_MEETING, "end_time"), "invitee_timezone": ("payload", "timezone"),
        "utm_source": ("payload", "tracking", "utm_source"), "utm_campaign": ("payload", "tracking", "utm_campaign"), "utm_medium": ("payload", "tracking", "utm_medium"),
    }
    rows = json_fields(bronze["calendly_booking"], paths).where("scheduled_event_uri is not null").withColumn("__t", iso_ts("created"))
    first = latest_by(rows, ["scheduled_event_uri"], [asc("__t"), asc("invitee_uri")])
    # of two keys only: the parse of another branch can't be shared, so it is kept small
    invitees = json_fields(bronze["calendly_booking"], {n: paths[n] for n in ("scheduled_event_uri", "invitee_uri")}).where("scheduled_event_uri is not null")
    counts = invitees.groupBy("scheduled_event_uri").agg(F.count_distinct("invitee_uri").alias("invitee_count"))
    gone = json_fields(bronze["calendly_cancellation"], {"scheduled_event_uri": (*_MEETING, "uri"), "at": ("payload", "cancellation", "created_at"), "updated": ("payload", "updated_at")})
    cancelled = gone.where("scheduled_event_uri is not null").groupBy("scheduled_event_uri").agg(F.min(F.coalesce("at", "updated")).alias("cancel_text"), F.lit(True).alias("hit"))
    out = first.join(_channels(bronze), "event_type", "left").join(cancelled, "scheduled_event_uri", "left").join(counts, "scheduled_event_uri", "left")
    start, zone = iso_ts("start"), known_zone("invitee_timezone")
    return _dated(
        out.select(
            "scheduled_event_uri", "meeting_name", "meeting_status", "event_type",
            F.coalesce("map_channel", F.lit(LATE_CHANNEL)).alias("channel"), F.coalesce("map_paid", F.lit(False)).alias("is_paid_channel"),
            F.col("__t").alias("created_at_utc"), local_date("__t").alias("booking_date_est"), start.alias("start_time_utc"), iso_ts("end").alias("end_time_utc"), "invitee_timezone",
            hour_of(local_ts(start, zone)).alias("start_hour_invitee_local"), iso_dow(local_ts(start, zone)).alias("start_dow_invitee_local"),
            hour_of(local_ts(start)).alias("start_hour_business_est"), iso_dow(local_ts(start)).alias("start_dow_business_est"),
            F.col("invitee_timezone").isNull().alias("missing_invitee_timezone"), "invitee_count", F.col("hit").isNotNull().alias("is_canceled"), iso_ts("cancel_text").alias("canceled_at"),
            "utm_source", "utm_campaign", "utm_medium",
        ),
        ctx,
    )


def fct_invitee(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """Latest state of each invitee with the latest cancellation."""
    names = ("email", "name", "first_name", "last_name", "timezone", "status", "created_at", "updated_at", "rescheduled", "questions_and_answers")
    paths = {"invitee_uri": ("payload", "uri"), "scheduled_event_uri": (*_MEETING, "uri")} | {n: ("payload", n) for n in names}
    rows = json_fields(bronze["calendly_booking"], paths, documents=("questions_and_answers",)).where("invitee_uri is not null")
    rows = latest_by(rows.withColumn("__t", iso_ts("updated_at")), ["invitee_uri"], [desc("__t"), desc("updated_at"), desc("created_at"), desc("scheduled_event_uri"), desc("status")])
    cancel = {"invitee_uri": ("payload", "uri"), "c_updated": ("payload", "updated_at"), "c_at": ("payload", "cancellation", "created_at"), "cancel_reason": ("payload", "cancellation", "reason"), "canceled_by": ("payload", "cancellation", "canceled_by")}
    gone = json_fields(bronze["calendly_cancellation"], cancel).where("invitee_uri is not null")
    gone = latest_by(gone, ["invitee_uri"], [desc("c_updated"), desc("c_at"), desc("cancel_reason")]).withColumn("hit", F.lit(True))
    created = iso_ts("created_at")
    return _dated(
        rows.join(gone, "invitee_uri", "left").select(
            "invitee_uri", "scheduled_event_uri", "email", norm_email("email").alias("email_normalized"), not_blank("email").alias("has_email"),
            F.col("name").alias("invitee_name"), "first_name", "last_name", F.col("timezone").alias("invitee_timezone"), F.col("status").alias("invitee_status"),
            created.alias("created_at_utc"), local_date(created).alias("booking_date_est"), F.col("__t").alias("updated_at_utc"),
            F.coalesce(F.col("rescheduled").try_cast("boolean"), F.lit(False)).alias("is_rescheduled"), F.col("hit").isNotNull().alias("is_canceled"),
            iso_ts(F.coalesce("c_at", "c_updated")).alias("canceled_at"), "cancel_reason", "canceled_by", F.col("questions_and_answers").alias("questions_and_answers_json"),
        ),
        ctx,
    )


def fct_booking_host(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """Bridge meeting - host. One row a meeting is taken before its hosts are unnested, so invitees don't multiply them."""
    paths = {"scheduled_event_uri": (*_MEETING, "uri"), "invitee_uri": ("payload", "uri"), "created": ("payload", "created_at"), "start": (*_MEETING, "start_time"), "event_type": (*_MEETING, "event_type"), "members": (*_MEETING, "event_memberships")}
    rows = json_fields(bronze["calendly_booking"], paths, documents=("members",)).where("scheduled_event_uri is not null")
    rows = latest_by(rows, ["scheduled_event_uri"], [asc("created"), asc("invitee_uri"), asc("start")])
    members = F.when(F.col("members").rlike(r"^\s*\["), F.from_json("members", "array<struct<user:string,user_email:string,user_name:string>>"))
    hosts = rows.withColumn("m", F.explode(members)).where("m.user is not null").join(_channels(bronze), "event_type", "left")
    return _dated(
        hosts.select(
            "scheduled_event_uri", F.col("m.user").alias("host_user_uri"), F.col("m.user_email").alias("host_email"), norm_email("m.user_email").alias("host_email_normalized"), F.col("m.user_name").alias("host_name"),
            F.coalesce("map_channel", F.lit(LATE_CHANNEL)).alias("channel"), iso_ts("start").alias("start_time_utc"), local_date(iso_ts("start")).alias("meeting_date_est"), local_date(iso_ts("created")).alias("booking_date_est"),
        ),
        ctx,
    )


def fct_spend(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """Newest publication of each date and channel, and how many files carried it. The seed is collapsed to channel first, so that several event types of a channel don't multiply its spend."""
    rows = json_fields(bronze["calendly_spend"], {"date": ("date",), "channel": ("channel",), "spend": ("spend",)}, keep=("asof",)).where("date is not null and channel is not null")
    rows = rows.withColumn("spend", F.col("spend").try_cast("double"))
    # count and newest row in one map-side combined aggregate
    newest = rows.groupBy("date", "channel").agg(F.max(F.struct("asof", "spend")).alias("top"), F.count("*").alias("source_file_count"))
    paid = _channels(bronze).groupBy(F.col("map_channel").alias("channel")).agg(F.max("map_paid").alias("map_paid"))
    return _dated(
        newest.join(paid, "channel", "left").select(
            F.col("date").cast("date").alias("spend_date"), "channel", F.col("top.spend").alias("spend"), F.coalesce("map_paid", F.lit(True)).alias("is_paid_channel"), F.col("top.asof").alias("sourced_from_asof"), "source_file_count",
        ),
        ctx,
    )


def dim_media(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """Newest snapshot of each medium."""
    names = ("name", "type", "duration", "description", "created", "updated")
    rows = json_fields(bronze["wistia_media"], {"hashed_id": ("hashed_id",)} | {n: (n,) for n in names}, keep=("asof",)).where("hashed_id is not null")
    rows = latest_by(rows, ["hashed_id"], [desc("asof"), desc("updated"), desc("name")]).withColumn("seconds", F.col("duration").try_cast("double"))
    return _dated(
        rows.select(
            "hashed_id", F.col("name").alias("media_name"), F.col("type").alias("media_type"), F.col("seconds").alias("duration_seconds"), round_to(F.col("seconds") / 60.0, 2).alias("duration_minutes"),
            "description", iso_ts("created").alias("media_created_at"), iso_ts("updated").alias("media_updated_at"), F.col("asof").alias("sourced_from_asof"),
        ),
        ctx,
    )


def fct_media_daily_stats(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """Daily flow of each medium, which only the file's name names. No play rate here: a ratio isn't additive."""
    paths = {"date": ("date",), "load_count": ("load_count",), "play_count": ("play_count",), "hours_watched": ("hours_watched",)}
    source = bronze["wistia_media_stats"].withColumn("hashed_id", stem("source_path"))
    rows = json_fields(source, paths, keep=("hashed_id", "dt")).where("date is not null")
    rows = latest_by(rows, ["hashed_id", "date"], [desc("dt"), desc("load_count"), desc("play_count"), desc("hours_watched")])
    loads, plays = F.col("load_count").try_cast("long"), F.col("play_count").try_cast("long")
    return _dated(
        rows.select("hashed_id", F.col("date").cast("date").alias("stat_date"), loads.alias("load_count"), plays.alias("play_count"), F.col("hours_watched").try_cast("double").alias("hours_watched"), ((loads == 0) & (plays == 0)).alias("is_zero_activity_day")),
        ctx,
    )


_VISIT = {
    "event_key": ("event_key",), "visitor_key": ("visitor_key",), "media_id": ("media_id",), "media_name": ("media_name",), "received": ("received_at",), "percent": ("percent_viewed",), "email": ("email",), "org": ("org",),
    "country": ("country",), "region": ("region",), "city": ("city",), "ip": ("ip",), "conversion_type": ("conversion_type",), "embed_url": ("embed_url",),
    "browser": ("user_agent_details", "browser"), "platform": ("user_agent_details", "platform"), "mobile": ("user_agent_details", "mobile"),
}


def dim_visitor(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """Latest attributes of each visitor; an e-mail once known survives later anonymous visits. One aggregate, no window."""
    rows = json_fields(bronze["wistia_visitor_event"], _VISIT).where("visitor_key is not null").withColumn("__t", iso_ts("received"))
    known = F.when(F.col("email").isNotNull(), F.col("__t"))
    last = [F.max_by(c, "__t").alias(c) for c in ("org", "country", "region", "city", "ip", "browser", "platform", "mobile")]
    seen = rows.groupBy("visitor_key").agg(F.max_by("email", known).alias("email"), *last, F.min("__t").alias("first_seen_at"), F.max("__t").alias("last_seen_at"))
    return _dated(
        seen.select(
            "visitor_key", "email", norm_email("email").alias("email_normalized"), not_blank("email").alias("is_identified"), "org", "country", "region", "city", "ip", "browser", "platform",
            F.col("mobile").try_cast("boolean").alias("is_mobile"), "first_seen_at", "last_seen_at",
        ),
        ctx,
    )


def fct_visitor_event(ctx: BuildContext, bronze: Tables) -> DataFrame:
    """One row a viewing session, from the newest partition that carries it."""
    rows = json_fields(bronze["wistia_visitor_event"], _VISIT, keep=("dt",)).where("event_key is not null")
    rows = latest_by(rows, ["event_key"], [desc("dt"), desc("received"), desc("percent"), desc("email")])
    at, percent = iso_ts("received"), F.col("percent").try_cast("double")
    return _dated(
        rows.select(
            "event_key", "visitor_key", F.col("media_id").alias("hashed_id"), "media_name", "email", norm_email("email").alias("email_normalized"), not_blank("email").alias("is_identified"),
            at.alias("received_at_utc"), local_date(at).alias("event_date_est"), percent.alias("percent_viewed"), (percent >= 0.25).alias("watched_quarter"), (percent >= 0.50).alias("watched_half"),
            "country", "region", "city", "org", "conversion_type", "embed_url",
        ),
        ctx,
    )


BUILDERS = {f.__name__: f for f in (dim_lead, dq_lead_coverage, fct_booking, fct_invitee, fct_booking_host, fct_spend, dim_media, fct_media_daily_stats, dim_visitor, fct_visitor_event)}
