"""Real-time branch: events are claimed once, enriched with their owner after a delay, announced, and put on a worklist if no owner is known.

The rules are pure DataFrame functions. ``run`` is one stateful stream: each event id has a keyed state that waits for the delay, then is pending under a
lease until its notice is known to be sent, and is claimed again when the lease runs out. Delay and lease are timers of the state store, so a
batch costs what falls due in it, not what waits. What falls due goes to ``announce``, which writes it down, asks for owners, sends, and leaves
acknowledgements in a folder that is the stream's second source. A batch that dies is run again from the state before it: nothing is
lost, and a notice may be sent twice, for it is sent before it is recorded. What calls out (owner lookups, notices) is evaluated once and its
answers are written before anything reads them. The owner cache and the worklist are tables changed by compare-and-set, since sweeps change them too."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from millrace.functions.dialect import asc, json_fields, latest_by
from millrace.sources import bronze, landing
from millrace.sources.state import GONE, StateTable

LEASE_SECONDS, DELAY_SECONDS = 120, 600
MAX_RETRIES, MAX_ROWS_PER_SWEEP, LISTED, MAX_RECEIVES = 24, 500, 20, 5
#: Batches whose written answers stay.
KEEP_BATCHES = 3
#: The texts of notices and escalations.
TITLE, GIVEN_UP_TITLE = "*New Lead Alert*", "*Owner reconciliation exhausted*"
LABELS = ("Name", "Lead ID", "Created Date", "Label", "Email", "Lead Owner", "Funnel")
NOT_PROVIDED, PENDING_VALUE, PENDING_OWNER = "_not provided_", "_pending_", "_pending assignment_"
LEDGER = "event_id string, status string, claimed_at long, sent_at long"
OWNERS = "lead_id string, lead_owner string, lead_email string, funnel string, display_name string, status_label string, date_created string, cached_at long"
AWAITING = "lead_id string, event_id string, first_seen_at long, retry_count int, status string, last_attempt_at long"
RESULTS = "event_id string, ok boolean, error string"
#: State of an event id, and what its timers let out.
CLAIM = "status string, raw string, attempts int, timer long"
DUE = "event_id string, raw string, attempts int, fate string"


def claim(deliveries: DataFrame, ledger: DataFrame, lease: int = LEASE_SECONDS) -> DataFrame:
    """event_id, claimed_at and deliveries of the events to work on now. deliveries: event_id, at (seconds).

    An event is claimed if it never was, or if its claim is pending and older than the lease; a sent one never is again."""
    first = deliveries.where("event_id is not null").groupBy("event_id").agg(F.min("at").alias("claimed_at"), F.max("at").alias("latest"), F.count("*").alias("deliveries"))
    known = ledger.select("event_id", F.col("status").alias("was"), F.col("claimed_at").alias("since"))
    free = F.col("was").isNull() | ((F.col("was") == "PENDING") & (F.col("since") < F.col("latest") - lease))
    return first.join(known, "event_id", "left").where(free).select("event_id", "claimed_at", "deliveries")


def resolve(leads: DataFrame, cache: DataFrame, source: DataFrame, now: int) -> tuple[DataFrame, DataFrame]:
    """(leads with owner columns, cache rows to add): the cache first, then the source; only answers found are cached."""
    fresh = landing.owner_rows(source.join(leads.select("lead_id").distinct(), "lead_id", "left_semi").join(cache.select("lead_id"), "lead_id", "left_anti"), now)
    return leads.join(cache.unionByName(fresh).drop("display_name", "status_label", "date_created", "cached_at"), "lead_id", "left").withColumn("found", F.coalesce("lead_owner", "lead_email", "funnel").isNotNull()), fresh


def missing(worklist: DataFrame, misses: DataFrame, now: int) -> DataFrame:
    """Worklist rows of leads that aren't on it yet."""
    new = latest_by(misses.select("lead_id", "event_id").where("lead_id is not null"), ["lead_id"], [asc("event_id")]).join(worklist.select("lead_id"), "lead_id", "left_anti")
    none = F.lit(None).cast("long")
    return new.select("lead_id", "event_id", F.lit(now).cast("long").alias("first_seen_at"), F.lit(0).alias("retry_count"), F.lit("AWAITING").alias("status"), none.alias("last_attempt_at"))


def add_missing(worklist: DataFrame, misses: DataFrame, now: int) -> DataFrame:
    """The worklist with leads added that aren't on it; those on it keep their counters."""
    return worklist.unionByName(missing(worklist, misses, now))


def longest_waiting(worklist: DataFrame, limit: int) -> DataFrame:
    """Those never tried first, then those whose last attempt is longest ago, so that everyone's turn comes."""
    return worklist.where("status = 'AWAITING'").orderBy(F.col("last_attempt_at").asc_nulls_first(), "lead_id").limit(limit)


def sweep(worklist: DataFrame, owners: DataFrame, now: int, failed: DataFrame | None = None, max_retries: int = MAX_RETRIES, limit: int | None = None) -> DataFrame:
    """Waiting rows with next_status (PROMOTED, AWAITING or EXHAUSTED) and next_count. Leads in ``failed``, whose lookup broke, use up no retry.

    The count before is kept beside the next one, so that whoever stores it can tell that nobody else has."""
    rows = worklist.where("status = 'AWAITING'")
    if limit is not None:
        rows = longest_waiting(rows, limit)
    if failed is not None:
        rows = rows.join(failed.select("lead_id"), "lead_id", "left_anti")
    hit = F.col("__owner").isNotNull()
    count = F.when(hit, F.col("retry_count")).otherwise(F.col("retry_count") + 1)
    rows = rows.join(owners.select("lead_id", F.lit(True).alias("__owner")).distinct(), "lead_id", "left").withColumn("next_count", count)
    status = F.when(hit, "PROMOTED").when(F.col("next_count") >= max_retries, "EXHAUSTED").otherwise("AWAITING")
    return rows.withColumn("next_status", status).withColumn("attempted_at", F.lit(now).cast("long")).drop("__owner")


def _outcome(worklist: DataFrame, swept: DataFrame) -> DataFrame:
    """The worklist with what a sweep makes of each row, __ours where it does, and __gone for rows promoted. A row whose count has changed
    since is left to whoever changed it."""
    s = swept.select("lead_id", F.col("retry_count").alias("__seen"), "next_status", "next_count", "attempted_at")
    rows = worklist.join(s, "lead_id", "left")
    ours = F.coalesce(F.col("__seen") == F.col("retry_count"), F.lit(False))
    pick = lambda new, old: F.when(ours, F.col(new)).otherwise(F.col(old)).alias(old)
    gone = ours & (F.col("next_status") == "PROMOTED")
    return rows.select("lead_id", "event_id", "first_seen_at", pick("next_count", "retry_count"), pick("next_status", "status"), pick("attempted_at", "last_attempt_at"), ours.alias("__ours"), gone.alias(GONE))


def apply_sweep(worklist: DataFrame, swept: DataFrame) -> DataFrame:
    """The worklist after a sweep: promoted rows go."""
    return _outcome(worklist, swept).where(~F.col(GONE)).drop("__ours", GONE)


def sweep_changes(worklist: DataFrame, swept: DataFrame) -> DataFrame:
    """The rows that a sweep changes or takes out (__gone)."""
    return _outcome(worklist, swept).where("__ours").drop("__ours")


def escalation(swept: DataFrame, max_retries: int = MAX_RETRIES, listed: int = LISTED) -> DataFrame:
    """One row of text about leads given up, the first few by name; no row if there are none."""
    gone = swept.where("next_status = 'EXHAUSTED'")
    names = gone.orderBy("lead_id").limit(listed).agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("• `"), "lead_id", F.lit("`")))), "\n").alias("names"))
    both = gone.agg(F.count("*").alias("n")).crossJoin(names).where("n > 0")
    more = F.when(F.col("n") > listed, F.concat(F.lit("\n…and "), F.col("n") - listed, F.lit(" more"))).otherwise("")
    return both.select(F.concat(F.lit(f"{GIVEN_UP_TITLE} — "), "n", F.lit(f" lead(s) had no owner file after {max_retries} hourly sweeps:\n"), "names", more).alias("text"), "n")


def alert_text(display_name: Column, lead_id: Column, date_created: Column, status_label: Column, email: Column, owner: Column, funnel: Column) -> Column:
    """The notice; a field that is missing says so."""
    values = (display_name, F.concat(F.lit("`"), F.coalesce(lead_id, F.lit("")), F.lit("`")), date_created, status_label, email, owner, funnel)
    blanks = (NOT_PROVIDED, "", "", "", PENDING_VALUE, PENDING_OWNER, PENDING_VALUE)
    lines = [F.lit(TITLE)] + [F.concat(F.lit(f"*{n}:* "), F.coalesce(F.nullif(v, F.lit("")), F.lit(b))) for n, v, b in zip(LABELS, values, blanks)]
    return F.concat_ws("\n", *lines)


EVENT_PATHS = {
    "event_id": ("event", "id"), "lead_id": ("event", "lead_id"), "action": ("event", "action"), "event_created": ("event", "date_created"), "display_name": ("event", "data", "display_name"),
    "status_label": ("event", "data", "status_label"), "data_created": ("event", "data", "date_created"),
}


def notices(claimed: DataFrame, owned: DataFrame) -> DataFrame:
    """event_id, lead_id and text of the claimed events."""
    e = claimed.join(owned, "lead_id", "left")
    return e.select("event_id", "lead_id", alert_text(F.col("display_name"), F.col("lead_id"), F.coalesce(F.nullif("data_created", F.lit("")), "event_created"), F.col("status_label"), F.col("lead_email"), F.col("lead_owner"), F.col("funnel")).alias("text"))


def owners_of(spark: SparkSession, state_root: str) -> StateTable:
    return StateTable(spark, f"{state_root}/owners", OWNERS)


def worklist_of(spark: SparkSession, state_root: str) -> StateTable:
    return StateTable(spark, f"{state_root}/awaiting", AWAITING)


def _written(df: DataFrame, path: str) -> DataFrame:
    """Evaluated once: written, and read from there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _looked_up(owner_source: Callable[[DataFrame], DataFrame], leads: DataFrame, path: str) -> DataFrame:
    """The source's answers, asked for once: lead_id, raw and failed."""
    answers = owner_source(leads)
    failed = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in answers.columns else F.lit(False)
    return _written(answers.select("lead_id", "raw", failed.alias("failed")), path)


class Claims(StatefulProcessor):
    """One event id: WAITING for the delay, PENDING under a lease, SENT, or DEAD after ``most`` claims that nobody acknowledged.

    An event is claimed when its delay is over and again whenever its lease is; each claim lets out a row. A sent one never is again, or not within
    ``remember`` seconds if that is given. Redeliveries of a known event change nothing."""

    def __init__(self, delay: float, lease: float, most: int = MAX_RECEIVES, remember: float | None = None):
        self.delay, self.lease, self.most, self.remember = delay, lease, most, remember

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("claim", CLAIM)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now, first, sent = timerValues.getCurrentProcessingTimeInMs(), None, False
        for r in rows:
            if r.kind == "sent":
                sent = True
            else:
                seen = (r.event_created is None, r.event_created or "", r.lead_id, r.raw, r.landed_at)
                first = seen if first is None else min(first, seen)
        if sent:
            self._keep("SENT", None, 0, None if self.remember is None else now + int(self.remember * 1000))
        elif first is not None and not self.state.exists():
            due = int((first[4] + self.delay) * 1000)
            if due <= now:
                yield self._claimed(key, first[3], 0, now)
            else:
                self._keep("WAITING", first[3], 0, due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, s = timerValues.getCurrentProcessingTimeInMs(), self.state.get()
        if s is None or s[3] != expiredTimerInfo.getExpiryTimeInMs():  # of a state that has moved on
            return
        status, raw, attempts, _ = s
        if status == "SENT":
            self.state.clear()
        elif status == "WAITING" or attempts < self.most:
            yield self._claimed(key, raw, attempts, now)
        else:
            self._keep("DEAD", raw, attempts, None)
            yield Row(event_id=key[0], raw=raw, attempts=attempts, fate="dead")

    def _claimed(self, key, raw: str, attempts: int, now: int) -> Row:
        self._keep("PENDING", raw, attempts + 1, now + int(self.lease * 1000))
        return Row(event_id=key[0], raw=raw, attempts=attempts + 1, fate="due")

    def _keep(self, status: str, raw: str | None, attempts: int, timer: int | None) -> None:
        self.state.update((status, raw, attempts, timer))
        if timer is not None:
            self.handle.registerTimer(timer)

    def close(self) -> None:
        pass


def claims(deliveries: DataFrame, delay: float, lease: float, most: int = MAX_RECEIVES, remember: float | None = None) -> DataFrame:
    """The stream of claims (event_id, raw, attempts, fate) of a stream of deliveries (event_id, kind: event or sent, lead_id, event_created, raw, landed_at)."""
    return deliveries.groupBy("event_id").transformWithState(Claims(delay, lease, most, remember), DUE, "Append", "ProcessingTime")


def announce(spark: SparkSession, due: DataFrame, state_root: str, owner_source: Callable[[DataFrame], DataFrame], send: Callable[[DataFrame], DataFrame], number: int = 0, now: int | None = None) -> None:
    """Enrich, send and acknowledge the claims of batch ``number`` (columns of DUE). ``owner_source`` answers (lead_id) with (lead_id, raw); ``send``
    announces (event_id, lead_id, text) and returns event_id, ok and error. A notice that fails isn't acknowledged and is claimed again after the lease.
    Dead claims are set aside in the folder ``dead``."""
    now = int(time.time()) if now is None else now
    at = lambda name, n=number: f"{state_root}/{name}/b{n}"
    claimed = _written(due, at("claims"))
    if claimed.isEmpty():
        return
    dead = claimed.where("fate = 'dead'")
    if not dead.isEmpty():
        dead.write.mode("overwrite").parquet(at("dead"))
    todo = json_fields(claimed.where("fate = 'due'"), EVENT_PATHS, keep=("raw",))
    leads, cache = todo.select("lead_id").distinct(), owners_of(spark, state_root)
    known = cache.read().join(leads, "lead_id", "left_semi")
    answers = _looked_up(owner_source, leads.join(known.select("lead_id"), "lead_id", "left_anti"), at("lookups"))
    owned, fresh = resolve(leads, known, answers.where("not failed").select("lead_id", "raw"), now)
    misses = todo.join(owned.where("not found").select("lead_id"), "lead_id", "left_semi")
    if not misses.isEmpty():
        worklist_of(spark, state_root).update(lambda rows: missing(rows, misses, now))
    result = _written(send(notices(todo, owned.select("lead_id", "lead_email", "lead_owner", "funnel"))).select("event_id", "ok", "error"), at("results"))
    if not fresh.isEmpty():
        cache.update(lambda rows: fresh.join(rows.select("lead_id"), "lead_id", "left_anti"))
    result.where("ok").select("event_id").distinct().write.mode("overwrite").json(at("acks"))
    for name in ("claims", "lookups", "results"):
        bronze.remove(spark, at(name, number - KEEP_BATCHES))


def run_sweep(spark: SparkSession, state_root: str, owner_source: Callable[[DataFrame], DataFrame], notify: Callable[[DataFrame], None], now: int | None = None, limit: int = MAX_ROWS_PER_SWEEP) -> dict[str, int]:
    """One scheduled pass over the worklist; returns its counts. ``owner_source`` may add a column ``failed`` for lookups that broke: those use up no retry.

    The outcome is applied to the worklist as it is then: what a stream has added meanwhile stays, and a row that another sweep has
    counted is left alone."""
    now = int(time.time()) if now is None else now
    folder = f"{state_root}/sweeps/{uuid.uuid4().hex}"
    cache, waiting = owners_of(spark, state_root), worklist_of(spark, state_root)
    work = _written(longest_waiting(waiting.read(), limit), f"{folder}/work")
    answers = _looked_up(owner_source, work.select("lead_id"), f"{folder}/lookups")
    failed = answers.where("failed").select("lead_id")
    found = landing.owner_rows(answers.where("not failed").select("lead_id", "raw"), now)
    swept = _written(sweep(work, found, now, failed), f"{folder}/swept")
    notify(escalation(swept))
    waiting.update(lambda rows: sweep_changes(rows, swept))
    cache.update(lambda rows: found.join(rows.select("lead_id"), "lead_id", "left_anti"))
    counts = {r["next_status"]: r["count"] for r in swept.groupBy("next_status").count().collect()}
    out = {"promoted": counts.get("PROMOTED", 0), "still_waiting": counts.get("AWAITING", 0), "exhausted": counts.get("EXHAUSTED", 0), "source_errors": failed.count()}
    bronze.remove(spark, folder)
    return out


def deliveries(events: DataFrame, acks: DataFrame) -> DataFrame:
    """Landed events (raw, landed_at) and acknowledgements (event_id) as one stream for ``claims``. Events without an id or a lead can't be handled ever."""
    rows = json_fields(events, EVENT_PATHS, keep=("raw", "landed_at")).where("event_id is not null and lead_id is not null")
    none = F.lit(None).cast("string")
    sent = acks.where("event_id is not null").select("event_id", F.lit("sent").alias("kind"), none.alias("lead_id"), none.alias("event_created"), none.alias("raw"), F.lit(None).cast("long").alias("landed_at"))
    return rows.select("event_id", F.lit("event").alias("kind"), "lead_id", "event_created", "raw", "landed_at").unionByName(sent)


def run(
    spark: SparkSession, bronze_root: str, state_root: str, owner_source, send, delay: float = DELAY_SECONDS, lease: float = LEASE_SECONDS, most: int = MAX_RECEIVES, remember: float | None = None,
    events: DataFrame | None = None, **trigger,
):
    """The streaming query over landed CRM events (or over ``events``: raw, landed_at), each handled ``delay`` seconds after it landed. It runs until it is
    stopped, by default with a batch every ten seconds, whether or not anything lands, for timers fall due in batches."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    if events is None:
        events = bronze.stream(spark, bronze_root, "crm_event").select("raw", F.unix_timestamp("_metadata.file_modification_time").alias("landed_at"))
    bronze.make_folder(spark, f"{state_root}/acks")
    acks = spark.readStream.schema("event_id string").option("recursiveFileLookup", True).option("cleanSource", "delete").json(f"{state_root}/acks")
    out = claims(deliveries(events, acks), delay, lease, most, remember)
    writer = out.writeStream.foreachBatch(lambda batch, number: announce(spark, batch, state_root, owner_source, send, number))
    return writer.option("checkpointLocation", f"{state_root}/checkpoint").trigger(**(trigger or {"processingTime": "10 seconds"})).start()
