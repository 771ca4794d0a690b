"""Small hand-made feeds."""

FUNNEL = "custom.cf_FUNNEL"


def crm(event_id, lead="lead_1", action="created", updated="2025-05-20T12:14:56.409000", label="Potential", name="Test Lead", funnel="VSL", **data):
    return {"subscription_id": "s", "event": {"id": event_id, "date_created": "2025-05-20T12:14:56.409000", "date_updated": updated, "object_type": "lead", "lead_id": lead, "action": action, "changed_fields": [], "data": {"id": lead, "display_name": name, "status_label": label, "date_created": "2025-05-20T12:14:56.409000+00:00", "date_updated": "2025-05-20T12:14:56.409000+00:00", "contact_ids": [], FUNNEL: funnel, **data}}}


def booking(meeting, invitee, created="2025-07-09T06:04:33.761871Z", start="2025-07-10T17:30:00.000000Z", zone="Asia/Kolkata", event_type="et/fb", email="a@x.com", hosts=("h1",), updated=None, rescheduled=False, event="invitee.created", cancellation=None, **tracking):
    payload = {
        "uri": f"https://b/{meeting}/invitees/{invitee}", "email": email, "name": "Ann A", "first_name": "Ann", "last_name": "A", "status": "active", "timezone": zone, "created_at": created, "updated_at": updated or created, "rescheduled": rescheduled,
        "questions_and_answers": [{"answer": "yes", "position": 0, "question": "ok?"}], "tracking": tracking,
        "scheduled_event": {"uri": f"https://b/{meeting}", "name": "Call", "status": "active", "event_type": event_type, "created_at": created, "start_time": start, "end_time": start, "event_memberships": [{"user": f"u/{h}", "user_email": f" {h.upper()}@X.com ", "user_name": h} for h in hosts]},
    }
    if cancellation:
        payload["cancellation"] = cancellation
    return {"event": event, "created_at": created, "payload": payload}


def visit(key, visitor="v1", at="2025-07-08T12:00:00Z", email=None, percent=0.5, media="m1", **more):
    return {"event_key": key, "visitor_key": visitor, "media_id": media, "media_name": "Intro", "received_at": at, "percent_viewed": percent, "email": email, "org": None, "country": "US", "region": "NY", "city": "X", "ip": "1.1.1.1", "conversion_type": "", "embed_url": "http://e", "user_agent_details": {"browser": "Firefox", "platform": "Linux", "mobile": False}, **more}
