"""Gold: metric marts. Components are summed to the mart's grain and divided once; grains are equal before tables are joined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.dialect import asc, desc, greatest_strict, ranked, ratio, ratio_to, round_to, week_start
from millrace.operators.silver import BuildContext, Tables, _dated

#: The texts that go with the figures.
TENURE_CAVEAT = "tenure proxied as first-meeting to window-end; true tenure needs an HR roster with effective dates, which Calendly does not provide"
NOT_MEASURABLE = "NOT MEASURABLE: no video session carries an email, so the bridge cannot join. This is not evidence that video drove no bookings."
LOWER_BOUND = "LOWER BOUND: anonymous watchers cannot join, so true video influence is at least this."


def _zero() -> Column:
    return F.lit(0).cast("long")


def _live() -> Column:
    return F.count_if(~F.col("is_canceled"))


def daily_calls_by_source(ctx: BuildContext, silver: Tables) -> DataFrame:
    by = silver["fct_booking"].groupBy(F.col("booking_date_est").alias("booking_date"), "channel", "is_paid_channel")
    out = by.agg(F.count("*").alias("bookings"), _live().alias("bookings_excl_canceled"), F.count_if("is_canceled").alias("bookings_canceled"), F.sum("invitee_count").alias("invitees"))
    return _dated(out.withColumn("avg_invitees_per_booking", ratio_to("invitees", "bookings", 2)), ctx)


def cpb_by_channel(ctx: BuildContext, silver: Tables) -> DataFrame:
    """Cost per booking. Days without a spend file (missing) stay apart from days whose file has no such channel (genuine zero)."""
    b = silver["fct_booking"].groupBy(F.col("booking_date_est").alias("metric_date"), "channel").agg(F.count("*").alias("n"), _live().alias("live"))
    s = silver["fct_spend"].groupBy(F.col("spend_date").alias("metric_date"), "channel").agg(F.sum("spend").alias("spend"))
    covered = s.select("metric_date").distinct().withColumn("covered", F.lit(True))  # from the summed spend, which is shuffled once for both
    # USING keeps the keys of either side; null dates never match
    rows = b.join(s, ["metric_date", "channel"], "full_outer").join(covered, "metric_date", "left")
    rows = rows.select("metric_date", "channel", "spend", F.coalesce("n", _zero()).alias("bookings"), F.coalesce("live", _zero()).alias("bookings_excl_canceled"), F.col("covered").isNotNull().alias("covered"))
    none = F.col("spend").isNull()
    rows = rows.withColumn("is_genuine_zero_spend", none & F.col("covered")).withColumn("is_spend_data_missing", none & ~F.col("covered"))
    week = Window.partitionBy("channel").orderBy(asc("metric_date")).rowsBetween(-6, 0)
    per = lambda n: F.when(~F.col("is_spend_data_missing"), ratio_to("spend", n, 2))
    return _dated(
        rows.select(
            "metric_date", "channel", "spend", "bookings", "bookings_excl_canceled", "is_genuine_zero_spend", "is_spend_data_missing", per("bookings").alias("cpb"), per("bookings_excl_canceled").alias("cpb_excl_canceled"),
            ratio_to(F.sum("spend").over(week), F.sum("bookings").over(week), 2).alias("cpb_7d_rolling"),
        ),
        ctx,
    )


def bookings_trend(ctx: BuildContext, silver: Tables) -> DataFrame:
    """Every day from the first to the last for every channel; days without bookings are zero."""
    b = silver["fct_booking"]
    span = b.agg(F.min("booking_date_est").alias("lo"), F.max("booking_date_est").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("booking_date"))
    actual = b.groupBy(F.col("booking_date_est").alias("booking_date"), "channel").agg(F.count("*").alias("n"), _live().alias("live"))
    dense = days.crossJoin(b.select("channel", "is_paid_channel").distinct()).join(actual, ["booking_date", "channel"], "left")
    rows = dense.select("booking_date", "channel", "is_paid_channel", F.coalesce("n", _zero()).alias("bookings"), F.coalesce("live", _zero()).alias("bookings_excl_canceled"))
    by = Window.partitionBy("channel").orderBy("booking_date")
    return _dated(
        rows.withColumn("booking_week", week_start("booking_date")).withColumn("bookings_7d_rolling", F.sum("bookings").over(by.rowsBetween(-6, 0))).withColumn("bookings_cumulative", F.sum("bookings").over(by)),
        ctx,
    )


def channel_attribution(ctx: BuildContext, silver: Tables, cpb_by_channel: DataFrame) -> DataFrame:
    """Leaderboard over the whole window, from this build's cost-per-booking mart. Ranks are over channels, of which there are few."""
    missing = F.col("is_spend_data_missing")
    by = cpb_by_channel.groupBy("channel").agg(
        F.sum("bookings").alias("total_bookings"), F.sum("bookings_excl_canceled").alias("total_bookings_excl_canceled"), F.sum(F.when(~missing, F.col("spend"))).alias("total_spend"),
        F.count("*").alias("days_observed"), F.count_if(missing).alias("days_spend_missing"), F.count_if("is_genuine_zero_spend").alias("days_zero_spend"), F.min("metric_date").alias("first_date"), F.max("metric_date").alias("last_date"),
    )
    per = lambda n: ratio("total_spend", n)
    return _dated(
        by.select(
            "channel", "total_bookings", "total_bookings_excl_canceled", "total_spend", round_to(per("total_bookings"), 2).alias("cpb"), round_to(per("total_bookings_excl_canceled"), 2).alias("cpb_excl_canceled"),
            F.rank().over(Window.orderBy(desc("total_bookings"))).cast("long").alias("rank_by_volume"), F.rank().over(Window.orderBy(asc(per("total_bookings")))).cast("long").alias("rank_by_efficiency"),
            "days_observed", "days_spend_missing", "days_zero_spend", ratio_to(F.col("days_observed") - F.col("days_spend_missing"), "days_observed", 4).alias("spend_coverage_rate"), "first_date", "last_date",
        ),
        ctx,
    )


def booking_time_slots(ctx: BuildContext, silver: Tables) -> DataFrame:
    """Hour by weekday, as the customer saw the clock and as the business did; each perspective's shares sum to one."""
    b = silver["fct_booking"]

    def slots(rows: DataFrame, name: str, hour: str, dow: str) -> DataFrame:
        by = rows.where(F.col(hour).isNotNull()).groupBy(F.col(hour).alias("hour_of_day"), F.col(dow).alias("day_of_week"), "channel")
        return by.agg(F.count("*").alias("bookings"), _live().alias("bookings_excl_canceled")).withColumn("perspective", F.lit(name))

    both = slots(b.where(~F.col("missing_invitee_timezone")), "customer_local", "start_hour_invitee_local", "start_dow_invitee_local").unionByName(slots(b, "business_est", "start_hour_business_est", "start_dow_business_est"))
    cover = b.agg(F.count("*").alias("total"), F.count_if("missing_invitee_timezone").alias("lost"))
    share = ratio_to("bookings", F.sum("bookings").over(Window.partitionBy("perspective")), 4)
    rate = F.when(F.col("perspective") == "customer_local", ratio_to(F.col("total") - F.col("lost"), "total", 4)).otherwise(F.lit(1.0))
    return _dated(both.crossJoin(cover).select("perspective", "hour_of_day", "day_of_week", "channel", "bookings", "bookings_excl_canceled", share.alias("share_of_perspective"), rate.alias("perspective_coverage_rate")), ctx)


def meeting_load_by_employee(ctx: BuildContext, silver: Tables) -> DataFrame:
    """Meetings of each host, by weeks of tenure. Counts go by host and day, host and week, then host: each distinct count is a plain one, no row is
    expanded for it, and all of it combines map-side by hash. Names, whose maximum doesn't, are an aggregate of their own on the same key."""
    hosts = silver["fct_booking_host"]
    day = hosts.groupBy("host_user_uri", "meeting_date_est").agg(F.count("*").alias("n"))
    week = day.groupBy("host_user_uri", week_start("meeting_date_est").alias("week")).agg(
        F.sum("n").alias("n"), F.count("meeting_date_est").alias("days"), F.min("meeting_date_est").alias("first"), F.max("meeting_date_est").alias("last"),
    )
    by = week.groupBy("host_user_uri").agg(
        F.sum("n").alias("total_meetings"), F.sum("days").alias("days_with_meetings"), F.count("week").alias("active_weeks"), F.min("first").alias("first_meeting_date"), F.max("last").alias("last_meeting_date"),
    )
    names = hosts.groupBy(F.col("host_user_uri").alias("__host")).agg(F.max("host_name").alias("host_name"), F.max("host_email").alias("host_email"))
    # the window's bounds are those of the table itself
    bounds = hosts.agg(F.min("meeting_date_est").alias("lo"), F.max("meeting_date_est").alias("hi"))
    rows = by.join(names, F.col("host_user_uri").eqNullSafe(F.col("__host"))).crossJoin(bounds)
    rows = rows.withColumn("tenure", greatest_strict(F.lit(1.0), F.datediff("hi", "first_meeting_date") / 7.0)).withColumn("window", F.datediff("hi", "lo") / 7.0)
    pace = ratio("total_meetings", "tenure")
    return _dated(
        ranked(rows, -pace, "rank_by_load").select(
            "host_user_uri", "host_name", "host_email", "total_meetings", "days_with_meetings", "active_weeks", "first_meeting_date", "last_meeting_date", round_to("tenure", 2).alias("tenure_weeks"), round_to("window", 2).alias("window_weeks"),
            round_to(pace, 2).alias("avg_meetings_per_week"), ratio_to("total_meetings", "window", 2).alias("avg_per_week_naive_window"), ratio_to("total_meetings", "active_weeks", 2).alias("avg_per_active_week"),
            "rank_by_load", F.lit(True).alias("tenure_is_proxied"), F.lit(TENURE_CAVEAT).alias("tenure_caveat"),
        ),
        ctx,
    )


def media_engagement(ctx: BuildContext, silver: Tables) -> DataFrame:
    """Daily, 7-row and to-date play rates: sums divided once, never averaged rates. All frames share one sort."""
    rows = silver["fct_media_daily_stats"].drop("build_date").join(silver["dim_media"].select("hashed_id", "media_name", "duration_minutes"), "hashed_id", "left")
    by = Window.partitionBy("hashed_id").orderBy(asc("stat_date"))
    week = by.rowsBetween(-6, 0)
    total = lambda c, w: F.sum(c).over(w)
    return _dated(
        rows.select(
            "hashed_id", "media_name", "stat_date", "duration_minutes", "load_count", "play_count", "hours_watched", "is_zero_activity_day", ratio_to("play_count", F.when(F.col("load_count") > 0, F.col("load_count")), 4).alias("play_rate"),
            ratio_to(total("play_count", week), total("load_count", week), 4).alias("play_rate_7d"), ratio_to(total("play_count", by), total("load_count", by), 4).alias("play_rate_to_date"),
            total("play_count", by).alias("plays_cumulative"), total("load_count", by).alias("loads_cumulative"), ratio_to(F.col("hours_watched") * 60.0, F.when(F.col("play_count") > 0, F.col("play_count")), 2).alias("avg_minutes_per_play"),
        ),
        ctx,
    )


def prior_touch(bookers: DataFrame, visits: DataFrame, days: int) -> DataFrame:
    """One row a booking that has earlier sessions of the same e-mail within the window: sessions, their mean and highest percentage.

    The join is on e-mail and a stretch of time a little longer than the window; a booking is looked up in its own stretch and the one before,
    so that a busy e-mail's rows meet only those near them. What is left of the range condition is a residual. The join is made once for both uses."""
    stretch = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / ((days + 1) * 86_400))
    own = stretch("created_at_utc")
    asked = bookers.where("email_normalized is not null").withColumn("stretch", F.explode(F.array(own, own - 1)))
    seen = visits.select("email_normalized", "received_at_utc", "percent_viewed", stretch("received_at_utc").alias("stretch"))
    when = (F.col("received_at_utc") < F.col("created_at_utc")) & (F.col("received_at_utc") >= F.col("created_at_utc") - F.expr(f"interval {days} days"))
    hit = asked.join(seen, ["email_normalized", "stretch"]).where(when)
    return hit.groupBy("scheduled_event_uri").agg(F.count("*").alias("sessions"), F.avg("percent_viewed").alias("avg_pv"), F.max("percent_viewed").alias("max_pv"))


def video_booking_funnel(ctx: BuildContext, silver: Tables) -> DataFrame:
    """Bookings with prior viewing within 30 days, per channel and day; a floor, for anonymous viewers can't be matched."""
    booking = silver["fct_booking"].select("scheduled_event_uri", "channel", F.col("booking_date_est").alias("booking_date"), "created_at_utc")
    bookers = booking.join(silver["fct_invitee"].select("scheduled_event_uri", "email_normalized"), "scheduled_event_uri", "left")
    touch = prior_touch(bookers, silver["fct_visitor_event"], 30)
    # both at the grain of a booking, so that heavy watchers don't inflate the counts
    per = bookers.groupBy("scheduled_event_uri", "channel", "booking_date").agg(F.max(F.col("email_normalized").isNotNull()).alias("mailed")).join(touch, "scheduled_event_uri", "left")
    agg = per.groupBy("channel", "booking_date").agg(
        F.count("*").alias("bookings"), F.count_if("mailed").alias("bookings_with_email"), F.count("sessions").alias("bookings_with_prior_video"), F.coalesce(F.sum("sessions"), _zero()).alias("prior_video_sessions"), F.avg("avg_pv").alias("pv"),
    )
    seen = silver["fct_visitor_event"].agg(F.count("*").alias("all_sessions"), F.count_if("is_identified").alias("identified"))
    return _dated(
        agg.crossJoin(seen).select(
            "channel", "booking_date", "bookings", "bookings_with_email", "bookings_with_prior_video", ratio_to("bookings_with_prior_video", "bookings", 4).alias("video_touch_rate_floor"), "prior_video_sessions", round_to("pv", 4).alias("avg_percent_viewed"),
            ratio_to("bookings_with_email", "bookings", 4).alias("booking_email_coverage"), ratio_to("identified", "all_sessions", 4).alias("video_identification_rate"), F.when(F.col("identified") == 0, NOT_MEASURABLE).otherwise(LOWER_BOUND).alias("interpretation"),
        ),
        ctx,
    )


BUILDERS = {f.__name__: f for f in (daily_calls_by_source, cpb_by_channel, bookings_trend, channel_attribution, booking_time_slots, meeting_load_by_employee, media_engagement, video_booking_funnel)}
