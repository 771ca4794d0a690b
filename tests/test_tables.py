"""Hand-computed rows of every table, from feeds through both layers."""

import datetime as dt

import pytest
from feeds import FUNNEL, booking, crm, visit

from millrace.operators.silver import BuildContext
from millrace.plans import build
from millrace.sources import bronze

ASOF = "2025-07-12"


@pytest.fixture
def layers(spark, land):
    root = land("crm/events/dt=2025-05-20/a.json", [crm("ev_1"), crm("ev_2", updated="garbage", label="Late")])
    land("crm/events/dt=2025-05-21/b.json", [crm("ev_3", lead="lead_2", name="Other"), "not json"])
    land(f"crm/lead_owner/asof={ASOF}/owners.ndjson", [{"lead_id": "lead_1", "lead_owner": "Bob", "lead_email": " Ann@X.com "}])
    land("crm/lead_owner/asof=2025-07-01/owners.ndjson", [{"lead_id": "lead_2", "lead_owner": "Old"}])
    land(f"crm/awaiting_owner/asof={ASOF}/awaiting.ndjson", [{"lead_id": "lead_2", "status": "AWAITING", "retry_count": 3}, {"lead_id": "lead_9", "status": "EXHAUSTED", "retry_count": 24}])
    land("seeds/channel_map/map.ndjson", [{"event_type": "et/fb", "channel": "facebook_paid_ads", "is_paid": True}, {"event_type": "et/fb2", "channel": "facebook_paid_ads", "is_paid": True}])
    land("seeds/custom_field_map/map.ndjson", [{"field_id": FUNNEL, "field_name": "funnel"}])
    land("calendly/bookings/dt=2025-07-09/x.json", [booking("m1", "i1", hosts=("h1", "h2")), booking("m1", "i2", created="2025-07-09T07:00:00Z", hosts=("h1", "h2"), email="  "), booking("m1", "i3", created="bad", hosts=("h1",), zone=None)])
    land("calendly/bookings/dt=2025-07-10/y.json", [booking("m2", "i4", created="2025-07-10T02:30:00Z", event_type="unmapped", zone=None, email="B@X.com", hosts=("h1",))])
    land("calendly/cancellations/dt=2025-07-11/c.json", [booking("m1", "i2", event="invitee.canceled", updated="2025-07-11T09:30:00Z", cancellation={"canceled_by": "Ann", "reason": "no time", "created_at": "2025-07-11T09:30:00.000000Z"})])
    for n, asof in enumerate(("2025-07-09", "2025-07-10")):
        land(f"calendly/spend/asof={asof}/spend_data_{asof}.json", [{"date": f"2025-07-0{8 + k}", "channel": "facebook_paid_ads", "spend": 100.0 + n} for k in range(2)])
    land("wistia/media/asof=2025-07-09/m1.json", [{"hashed_id": "m1", "name": "Old", "type": "Video", "duration": 90}])
    land("wistia/media/asof=2025-07-10/m1.json", [{"hashed_id": "m1", "name": "Intro", "type": "Video", "duration": 100, "created": "2025-01-01T00:00:00+00:00"}])
    for day, loads, plays in (("2025-07-08", 6455, 48), ("2025-07-09", 44, 18), ("2025-07-10", 0, 0)):
        land(f"wistia/media_stats/dt={day}/m1.json", [{"date": day, "load_count": loads, "play_count": plays, "hours_watched": plays / 60}])
    land("wistia/visitor_events/dt=2025-07-08/m1.json", [visit("e1", email=" A@x.com"), visit("e2", at="2025-07-09T01:00:00Z", percent=0.3), visit("e3", visitor="v2", at="2025-07-10T00:00:00Z", email="a@x.com", percent="bad")])
    land("wistia/visitor_events/dt=2025-07-09/m1.json", [visit("e2", at="2025-07-09T01:00:00Z", percent=0.4), visit("e4", at="2025-05-01T00:00:00Z", email="a@x.com")])
    ctx = BuildContext("b", ASOF, FUNNEL)
    silver, gold = build.preview(ctx, bronze.read_all(spark, root))
    return root, silver, gold


def rows(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


def test_silver(layers):
    _, s, _ = layers
    lead = rows(s["dim_lead"], "lead_id")
    assert set(lead) == {"lead_1", "lead_2"}
    a = lead["lead_1"]
    assert (a.source_event_id, a.status_label, a.funnel, a.enrichment_status, a.lead_email_normalized) == ("ev_1", "Potential", "VSL", "ENRICHED", "ann@x.com")
    assert a.lead_created_at == dt.datetime(2025, 5, 20, 12, 14, 56, 409000) and lead["lead_2"].enrichment_status == "AWAITING_OWNER"
    q = s["dq_lead_coverage"].collect()
    assert len(q) == 1 and (q[0].total_leads, q[0].email_match_rate, q[0].awaiting_owner_open, q[0].awaiting_owner_exhausted, q[0].max_retry_count, q[0].owner_cache_size) == (2, 0.5, 1, 1, 24, 1)
    b = rows(s["fct_booking"], "scheduled_event_uri")
    m = b["https://b/m1"]
    assert (m.invitee_count, m.channel, m.is_paid_channel, m.is_canceled, m.invitee_timezone) == (3, "facebook_paid_ads", True, True, "Asia/Kolkata")
    assert m.created_at_utc == dt.datetime(2025, 7, 9, 6, 4, 33, 761871) and m.canceled_at == dt.datetime(2025, 7, 11, 9, 30)
    assert (m.start_hour_invitee_local, m.start_dow_invitee_local, m.start_hour_business_est, m.start_dow_business_est) == (23, 4, 13, 4)
    n = b["https://b/m2"]
    assert (n.channel, n.is_paid_channel, n.missing_invitee_timezone, n.start_hour_invitee_local, n.booking_date_est) == ("other", False, True, None, dt.date(2025, 7, 9))
    i = rows(s["fct_invitee"], "invitee_uri")
    assert len(i) == 4 and not i["https://b/m1/invitees/i2"].has_email and i["https://b/m1/invitees/i2"].cancel_reason == "no time" and i["https://b/m1/invitees/i1"].questions_and_answers_json.startswith("[{")
    h = rows(s["fct_booking_host"], "scheduled_event_uri", "host_user_uri")
    assert set(h) == {("https://b/m1", "u/h1"), ("https://b/m1", "u/h2"), ("https://b/m2", "u/h1")} and h["https://b/m1", "u/h1"].host_email_normalized == "h1@x.com"
    p = rows(s["fct_spend"], "spend_date")
    assert len(p) == 2 and all(r.spend == 101.0 and r.source_file_count == 2 and r.sourced_from_asof == "2025-07-10" for r in p.values())
    d = s["dim_media"].first()
    assert (d.media_name, d.duration_minutes, d.sourced_from_asof) == ("Intro", 1.67, "2025-07-10")
    st = rows(s["fct_media_daily_stats"], "stat_date")
    assert len(st) == 3 and st[dt.date(2025, 7, 10)].is_zero_activity_day and st[dt.date(2025, 7, 8)].hashed_id == "m1"
    v = rows(s["dim_visitor"], "visitor_key")
    assert v["v1"].email_normalized == "a@x.com" and v["v1"].is_identified and v["v1"].last_seen_at == dt.datetime(2025, 7, 9, 1)
    e = rows(s["fct_visitor_event"], "event_key")
    assert len(e) == 4 and e["e2"].percent_viewed == 0.4 and e["e3"].watched_half is None and e["e2"].event_date_est == dt.date(2025, 7, 8)


def test_gold(layers):
    _, _, g = layers
    c = rows(g["daily_calls_by_source"], "channel")
    assert (c["facebook_paid_ads"].bookings, c["facebook_paid_ads"].bookings_canceled, c["facebook_paid_ads"].avg_invitees_per_booking) == (1, 1, 3.0)
    p = rows(g["cpb_by_channel"], "metric_date", "channel")
    fb8, fb9, other = p[dt.date(2025, 7, 8), "facebook_paid_ads"], p[dt.date(2025, 7, 9), "facebook_paid_ads"], p[dt.date(2025, 7, 9), "other"]
    assert (fb8.bookings, fb8.cpb, fb9.cpb, fb9.cpb_excl_canceled, fb9.cpb_7d_rolling) == (0, None, 101.0, None, 202.0)
    assert other.spend is None and other.is_genuine_zero_spend and not other.is_spend_data_missing and other.cpb is None
    assert g["bookings_trend"].count() == 2
    a = rows(g["channel_attribution"], "channel")
    assert (a["facebook_paid_ads"].cpb, a["facebook_paid_ads"].rank_by_efficiency, a["other"].rank_by_efficiency, a["facebook_paid_ads"].days_observed) == (202.0, 1, 2, 2)
    t = rows(g["booking_time_slots"], "perspective", "channel")
    assert len(t) == 3 and t["customer_local", "facebook_paid_ads"].perspective_coverage_rate == 0.5 and t["business_est", "other"].share_of_perspective == 0.5
    m = rows(g["meeting_load_by_employee"], "host_user_uri")
    assert (m["u/h1"].total_meetings, m["u/h1"].tenure_weeks, m["u/h1"].avg_per_week_naive_window, m["u/h1"].rank_by_load, m["u/h2"].rank_by_load) == (2, 1.0, None, 1, 2)
    e = rows(g["media_engagement"], "stat_date")
    assert [e[dt.date(2025, 7, d)].play_rate for d in (8, 9, 10)] == [0.0074, 0.4091, None]
    assert e[dt.date(2025, 7, 9)].play_rate_to_date == 0.0102 and e[dt.date(2025, 7, 10)].play_rate_7d == 0.0102 and e[dt.date(2025, 7, 8)].avg_minutes_per_play == 1.0
    f = rows(g["video_booking_funnel"], "channel")
    x = f["facebook_paid_ads"]
    assert (x.bookings, x.bookings_with_email, x.bookings_with_prior_video, x.prior_video_sessions, x.video_touch_rate_floor, x.avg_percent_viewed) == (1, 1, 1, 2, 1.0, 0.5)  # two invitees share the e-mail
    assert f["other"].bookings_with_prior_video == 0 and x.video_identification_rate == 0.75 and x.interpretation.startswith("LOWER BOUND")


def test_grains_are_unique(layers):
    _, s, g = layers
    keys = {"dim_lead": ["lead_id"], "fct_booking": ["scheduled_event_uri"], "fct_invitee": ["invitee_uri"], "fct_booking_host": ["scheduled_event_uri", "host_user_uri"], "fct_spend": ["spend_date", "channel"], "dim_media": ["hashed_id"], "fct_media_daily_stats": ["hashed_id", "stat_date"], "dim_visitor": ["visitor_key"], "fct_visitor_event": ["event_key"]}
    for name, k in keys.items():
        assert s[name].count() == s[name].select(*k).distinct().count(), name
    for t in [*s.values(), *g.values()]:
        assert "build_date" in t.columns


def test_empty_feeds_build(spark, tmp_path):
    silver, gold = build.preview(BuildContext("b", ASOF, FUNNEL), bronze.read_all(spark, str(tmp_path / "nothing")))
    assert {n for n, t in silver.items() if t.count()} == {"dq_lead_coverage"}
    assert all(t.count() == 0 for t in gold.values())


def test_partition_filter_prunes(spark, layers):
    root, _, _ = layers
    df = bronze.read(spark, root, "lead_owner").where(f"asof = '{ASOF}'")
    assert df.schema["asof"].dataType.simpleString() == "string"
    assert "PartitionFilters: [isnotnull(asof" in df._jdf.queryExecution().toString()


def test_spend_of_overlapping_windows_collapses(spark, land):
    days = [dt.date(2025, 1, 1) + dt.timedelta(n) for n in range(59)]
    for n in range(30):
        asof = days[29] + dt.timedelta(n + 1)
        root = land(f"calendly/spend/asof={asof}/spend_data_{asof}.json", [{"date": str(d), "channel": c, "spend": 1.0} for d in days[n : n + 30] for c in ("facebook_paid_ads", "youtube_paid_ads", "tiktok_paid_ads")])
    tables = bronze.read_all(spark, root)
    from millrace.operators.silver import fct_spend

    assert tables["calendly_spend"].count() == 2700
    assert fct_spend(BuildContext("b", ASOF), tables).count() == 177
