"""Landing operators: webhook validation and routing, spend-file diffing, day-window pulls and state exports, all as DataFrame
transformations whose keys are pure functions of the payload."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.dialect import desc, json_fields, json_leaves, keys_of, last_segment, latest_by, ratio
from millrace.sources import bronze, keyed
from millrace.sources.state import StateTable

#: Event type -> feed, file stem, timestamps that date it, in order; columns of the manifest; names of spend files.
ROUTES = {
    "invitee.created": ("calendly_booking", "calendly_event", ("$.payload.created_at",)),
    "invitee.canceled": ("calendly_cancellation", "calendly_cancel", ("$.payload.cancellation.created_at", "$.payload.updated_at", "$.payload.created_at")),
}
MANIFEST = "asof string, content_hash string, size_bytes long, pulled_at long, row_count long, date_min string, date_max string, distinct_dates long, channels string"
SPEND_FILE = r"^spend_data_(\d{4}-\d{2}-\d{2})\.json$"
LOOKBACK_DAYS = 7
OWNER_FIELDS = ("lead_owner", "lead_email", "funnel", "display_name", "status_label", "date_created")


def body_of(body: str | Column, is_base64: str | Column) -> Column:
    """The verbatim request body."""
    b = F.col(body) if isinstance(body, str) else body
    flag = F.col(is_base64) if isinstance(is_base64, str) else is_base64
    return F.when(F.coalesce(flag, F.lit(False)), F.try_to_binary(b, F.lit("base64")).cast("string")).otherwise(b)


def day_of(text: Column) -> Column:
    """The first ten characters of a timestamp text; null if it is shorter."""
    return F.when(F.length(text) >= 10, F.substring(text, 1, 10))


def _with_leaves(requests: DataFrame, body: str, paths: dict[str, tuple[str, ...]]) -> tuple[DataFrame, dict[str, Column]]:
    """requests with raw and one parse of it, in ``__json``; and how to read the paths."""
    parsed, leaves = json_leaves(body, paths)
    return requests.withColumn("raw", F.col(body)).select("*", F.explode_outer(F.array(parsed)).alias("__json")), leaves


def crm_events(requests: DataFrame, body: str = "body") -> DataFrame:
    """raw, dt, key and status_code of CRM webhook bodies. 400: not JSON, or no id or no date; 200: to be landed under key."""
    rows, of = _with_leaves(requests, body, {"id": ("event", "id"), "created": ("event", "date_created")})
    ident, dt = of["id"], F.substring(F.coalesce(of["created"], F.lit("")), 1, 10)
    ok = F.coalesce(F.try_parse_json("raw").isNotNull() & ident.isNotNull() & (ident != "") & (F.length(dt) == 10), F.lit(False))
    rows = rows.withColumn("status_code", F.when(ok, 200).otherwise(400)).withColumn("dt", F.when(ok, dt))
    return rows.withColumn("key", F.when(ok, F.concat(F.lit("crm/events/dt="), dt, F.lit("/crm_event_"), ident, F.lit(".json")))).drop("__json")


def booking_events(requests: DataFrame, body: str = "body") -> DataFrame:
    """raw, feed, dt, key and status_code of booking webhook bodies. Unknown event types are accepted and ignored: 200, without feed and key."""
    dates = {path: keys_of(path) for _, _, paths in ROUTES.values() for path in paths}
    rows, of = _with_leaves(requests, body, {"event": ("event",), "uri": ("payload", "uri")} | dates)
    event, uuid = of["event"], last_segment(of["uri"])
    feed, stem, dt = (F.lit(None).cast("string") for _ in range(3))
    for name, (table, prefix, paths) in ROUTES.items():
        here = event == name
        feed, stem = F.when(here, table).otherwise(feed), F.when(here, prefix).otherwise(stem)
        dt = F.when(here, F.coalesce(*[day_of(of[p]) for p in paths])).otherwise(dt)
    known = event.isin(*ROUTES)
    ok = F.coalesce(known & uuid.isNotNull() & dt.isNotNull(), F.lit(False))
    ignored = F.coalesce(F.try_parse_json("raw").isNotNull() & event.isNotNull() & ~known, F.lit(False))
    path = F.when(feed == "calendly_booking", "calendly/bookings").otherwise("calendly/cancellations")
    return (
        rows.withColumn("status_code", F.when(ok | ignored, 200).otherwise(400)).withColumn("feed", F.when(ok, feed)).withColumn("dt", F.when(ok, dt))
        .withColumn("key", F.when(ok, F.concat(path, F.lit("/dt="), dt, F.lit("/"), stem, F.lit("_"), uuid, F.lit(".json")))).drop("__json")
    )


def with_signature(parsed: DataFrame, verified: str | Column) -> DataFrame:
    """The status contract with signatures: 400 malformed goes first, then 401 for a bad signature, whose event loses its key."""
    ok = F.coalesce(F.col(verified) if isinstance(verified, str) else verified, F.lit(False))
    refused = (F.col("status_code") == 200) & ~ok
    return parsed.withColumn("key", F.when(~refused, F.col("key"))).withColumn("status_code", F.when(refused, 401).otherwise(F.col("status_code")))


def once(landed: DataFrame, order: str | None = None) -> DataFrame:
    """One line a key, the last delivered by ``order``; redelivery overwrites itself. Without an order, fails when run on a key with unlike bodies,
    for it can't be told which of them stays."""
    rows = landed.where("key is not null")
    if order is not None:
        return latest_by(rows, ["key"], [desc(order), desc("raw")])
    by = Window.partitionBy("key")
    fault = F.raise_error(F.concat(F.lit("an order is needed to land unlike bodies of "), "key"))
    same = F.when(F.min("raw").over(by) == F.max("raw").over(by), F.col("raw")).when(F.col("raw").isNotNull(), fault)
    return latest_by(rows.withColumn("raw", same), ["key"], [desc("raw")])


def advertised(index: DataFrame, content: str = "content") -> DataFrame:
    """asof and filename of every spend file that a published index names: a list, or an object with a list under "files", of names or of
    objects with a "file". Fails when run on another shape, or on an index that names none: silence would pass for "nothing new"."""
    listed = F.coalesce(F.get_json_object(content, "$.files"), F.col(content))
    entries = F.when(listed.rlike(r"^\s*\["), F.from_json(listed, "array<string>"))
    path = lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$.file")).otherwise(x)
    names = F.filter(F.transform(entries, lambda x: F.element_at(F.split(path(x), "/"), -1)), lambda n: n.rlike(SPEND_FILE))
    fault = F.when(entries.isNull(), "unknown shape of file index").when(F.size(names) == 0, "the file index names no spend file")
    checked = F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(names)
    return index.select(F.explode(checked).alias("filename")).select(F.regexp_extract("filename", SPEND_FILE, 1).alias("asof"), "filename").distinct()


def read_files(spark: SparkSession, path: str, pattern: str = "spend_data_*.json") -> DataFrame:
    """asof, filename, content (text), content_hash (SHA-256 of the bytes) and size_bytes of published files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    asof = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1)
    return files.select(asof.alias("asof"), name.alias("filename"), F.col("content").cast("string").alias("content"), F.sha2("content", 256).alias("content_hash"), F.col("length").alias("size_bytes"))


def classify(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """files with state: new, corrected (other content than recorded), unchanged, or invalid (not JSON); the latter isn't landed or recorded."""
    known = manifest.select("asof", F.col("content_hash").alias("known_hash"))
    state = (
        F.when(F.col("known_hash") == F.col("content_hash"), "unchanged").when(F.try_parse_json("content").isNull(), "invalid").when(F.col("known_hash").isNull(), "new").otherwise("corrected")
    )
    return files.join(known, "asof", "left").withColumn("state", state).drop("known_hash")


def still_missing(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """As-of dates that are advertised but not recorded."""
    return index.select("asof").distinct().join(manifest.select("asof"), "asof", "left_anti").orderBy("asof")


def demux(files: DataFrame) -> DataFrame:
    """One line a record of a JSON array, values untouched; a lone object is one line."""
    rows = F.from_json("content", "array<string>")
    one = F.when(F.col("content").rlike(r"^\s*\["), rows).otherwise(F.array(F.col("content")))
    return files.select("asof", "filename", F.explode(one).alias("raw"))


def profile(files: DataFrame) -> DataFrame:
    """Row and date coverage of each file, so that zero can be told from missing."""
    rows = json_fields(demux(files), {"d": ("date",), "c": ("channel",)}, keep=("asof", "filename"))
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    return rows.groupBy("asof", "filename").agg(F.count("*").alias("row_count"), F.min(some("d")).alias("date_min"), F.max(some("d")).alias("date_max"), F.count_distinct(some("d")).alias("distinct_dates"), F.array_join(F.array_sort(F.collect_set(some("c"))), ",").alias("channels"))


def record(manifest: DataFrame, entries: DataFrame, key: str = "asof", order: str = "pulled_at") -> DataFrame:
    """The manifest with entries added or replaced; written after the data that it vouches for."""
    return latest_by(manifest.unionByName(entries, allowMissingColumns=True), [key], [desc(order), desc("content_hash")])


def spend_pull(files: DataFrame, manifest: DataFrame, pulled_at: int) -> tuple[DataFrame, DataFrame]:
    """(lines to land, new manifest) of one run over all advertised files. Any gap is closed by the next run, for the diff has no cursor."""
    todo = classify(files, manifest).where("state in ('new', 'corrected')")
    entries = todo.select("asof", "content_hash", "size_bytes", F.lit(pulled_at).cast("long").alias("pulled_at")).join(profile(todo).drop("filename"), "asof", "left")
    return demux(todo), record(manifest, entries)


def land_spend(spark: SparkSession, files: DataFrame, bronze_root: str, manifest: StateTable, pulled_at: int) -> list[str]:
    """Land what is new or corrected in ``files`` and record it; gives back the as-of dates landed. Data goes first, the manifest that vouches for it after.

    The manifest is changed by compare-and-set: of two runs at once the later one looks again at what is still to do, and neither's entries are lost."""
    landed: list[str] = []

    def change(known: DataFrame) -> DataFrame:
        todo = classify(files, known).where("state in ('new', 'corrected')")
        entries = todo.select("asof", "content_hash", "size_bytes", F.lit(pulled_at).cast("long").alias("pulled_at")).join(profile(todo).drop("filename"), "asof", "left")
        landed[:] = sorted(r["asof"] for r in todo.select("asof").collect())  # a file a day
        if landed:
            bronze.land(demux(todo), bronze_root, "calendly_spend")
        return entries

    manifest.update(change)
    return landed


def window(spark: SparkSession, start: str | None = None, end: str | None = None, today: str | None = None, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """dt: every day of the inclusive window to pull, as given or the last ``lookback`` days. Fails when run on a window that ends before it starts."""
    given = start is not None and end is not None
    last = F.lit(end if given else today).cast("date") if given or today else F.current_date()
    first = F.lit(start).cast("date") if given else F.date_sub(last, lookback - 1)
    bounds = spark.range(1).select(first.alias("first"), last.alias("last"))
    days = F.when(F.col("last") < F.col("first"), F.raise_error(F.concat(F.lit("the window ends before its start "), F.col("first")))).otherwise(F.sequence("first", "last"))
    return bounds.select(F.explode(days).alias("dt")).select(F.col("dt").cast("string").alias("dt"))


def pulls(days: DataFrame, media: DataFrame, kind: str = "events") -> DataFrame:
    """One row for each medium (hashed_id) and day (dt) to ask for, with the key that the manifest knows it by."""
    span = days.agg(F.array_sort(F.collect_set("dt")).alias("days"))  # one row: a window is a few days
    both = media.select("hashed_id").distinct().crossJoin(span).select("hashed_id", F.explode("days").alias("dt"))
    return both.select("hashed_id", "dt", F.concat_ws("#", F.lit(kind), "hashed_id", "dt").alias("pull_key"))


#: Where the answers of each kind of pull go.
PULL_PATHS = {"events": ("wistia/visitor_events", "dt"), "stats": ("wistia/media_stats", "dt"), "media": ("wistia/media", "asof")}


def pull_objects(asked: DataFrame, answers: DataFrame, kind: str) -> DataFrame:
    """key, body, row_count and content_hash: one object for each medium and day asked for, lines sorted, so that an unchanged re-pull is the same bytes.

    A day without rows is an empty object, for it shows that we asked. A window's rows are bounded by what the source lets a window have."""
    lines = answers.where("raw is not null").groupBy("hashed_id", "dt").agg(F.array_sort(F.collect_list(canonical("raw"))).alias("lines"))
    prefix, part = PULL_PATHS[kind]
    full = asked.join(lines, ["hashed_id", "dt"], "left")
    body = F.when(F.col("lines").isNull(), "").otherwise(F.concat(F.array_join("lines", "\n"), F.lit("\n")))
    key = F.concat(F.lit(f"{prefix}/{part}="), "dt", F.lit("/"), "hashed_id", F.lit(".json"))
    return full.select("hashed_id", "dt", "pull_key", key.alias("key"), body.alias("body"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("row_count"), F.sha2(body, 256).alias("content_hash"))


def identification(events: DataFrame, email: str = "email") -> DataFrame:
    """How many pulled events carry an e-mail address, and their share; the share of no events is null."""
    known = F.count_if(F.trim(F.coalesce(F.col(email), F.lit(""))) != "")
    return events.agg(F.count("*").alias("events"), known.alias("identified")).withColumn("identification_rate", ratio("identified", "events"))


def object_key(c: str | Column) -> Column:
    """A storage notice's object key, percent-decoded; a plus is a space. A key that can't be decoded is null."""
    return F.try_url_decode(F.col(c) if isinstance(c, str) else c)


def one_line(raw: str | Column) -> Column:
    """A body as one line: as it came, or written anew if it holds line breaks."""
    c = F.col(raw) if isinstance(raw, str) else raw
    return F.when(c.rlike(r"[\r\n]"), F.to_json(F.parse_json(c))).otherwise(c)


def land_events(parsed: DataFrame, root: str, order: str | None = None) -> None:
    """Write webhook events (key, raw), one object a key as ``once`` picks it: a redelivery replaces itself, and every other event of the day stays."""
    keyed.write(once(parsed, order).select("key", one_line("raw").alias("body")), root)


def answer(parsed: DataFrame, root: str, answers: str, order: str | None = None) -> DataFrame:
    """Land the accepted requests and say how each is answered: parsed with its final status_code. What became of each object is written to the folder ``answers``.

    Refused requests (400, 401) and ignored ones keep their status. An accepted one whose object couldn't be stored is answered with 500, so that its sender
    tries again; each object's fate is its own, for one that fails doesn't keep the others from being stored."""
    tried = keyed.try_write(once(parsed, order).select("key", one_line("raw").alias("body")), root)
    tried.write.mode("overwrite").parquet(answers)  # each object is stored once, however often the answers are read
    failed = parsed.sparkSession.read.schema("key string, fault string").parquet(answers).where("fault is not null").select("key", F.lit(True).alias("__failed"))
    return parsed.join(failed, "key", "left").withColumn("status_code", F.when(F.col("__failed"), 500).otherwise(F.col("status_code"))).drop("__failed")


def land_stream(requests: DataFrame, root: str, checkpoint: str, parse: Callable[[DataFrame], DataFrame] = crm_events, within: str = "1 day", **trigger):
    """A streaming query that lands webhook requests (body, at: when each was received) once. A redelivery within ``within`` of its first is dropped by keyed state, in the
    same batch or a later one; one that comes later than that replaces its own object."""
    keys = parse(requests.withWatermark("at", within)).where("key is not null").select("key", "raw", "at")
    firsts = keys.dropDuplicatesWithinWatermark(["key"])
    writer = firsts.writeStream.foreachBatch(lambda batch, _: land_events(batch, root, "at")).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def land_pulls(objects: DataFrame, root: str) -> None:
    """Write the objects of a pull (key, body) under names that Silver reads the medium from."""
    keyed.write(objects, root)


def canonical(raw: str | Column) -> Column:
    """JSON with sorted keys, so that an unchanged re-pull is byte-identical."""
    return F.to_json(F.parse_json(F.col(raw) if isinstance(raw, str) else raw))


def export_snapshot(rows: DataFrame, asof: str) -> DataFrame:
    """raw and asof: a keyed table's rows as one JSON line each, keys sorted, nulls left out."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns))).alias("raw"), F.lit(asof).alias("asof"))


def flatten_typed(raw: str | Column, columns: dict[str, str]) -> list[Column]:
    """Plain columns from typed-attribute JSON ({"name": {"S": ...}} with S, N, BOOL or NULL), each cast to its type. The text is parsed once for all of
    them; one that isn't JSON, or repeats a key, gives nulls."""
    item, out = F.try_parse_json(F.col(raw) if isinstance(raw, str) else raw), []
    for name, kind in columns.items():
        at = lambda t, n=name: F.try_variant_get(item, f"$['{n}'].{t}", "string")
        out.append(F.coalesce(at("S"), at("N"), at("BOOL")).try_cast(kind).alias(name))
    return out


def owner_rows(owner_json: DataFrame, cached_at: int) -> DataFrame:
    """Owner cache rows from lookup answers (lead_id, raw): blanks are left out, and an absent answer is never cached."""
    rows = json_fields(owner_json.where("raw is not null"), {f: (f,) for f in OWNER_FIELDS}, keep=("lead_id",))
    return rows.select("lead_id", *[F.nullif(f, F.lit("")).alias(f) for f in OWNER_FIELDS], F.lit(cached_at).cast("long").alias("cached_at"))


def synthetic_events(spark: SparkSession, n: int, repeat: int = 1, start: str = "2025-05-20 12:00:00") -> DataFrame:
    """Replayable CRM events: n distinct ones, each delivered ``repeat`` times; every third is an update."""
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(start)) + F.col("id"))
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    lead = F.concat(F.lit("lead_"), F.lpad((F.col("id") % F.greatest(F.lit(1), F.lit(n) / 2).cast("long")).cast("string"), 6, "0"))
    updated = F.col("id") % 3 == 2
    data = F.struct(lead.alias("id"), F.concat(F.lit("Test Lead "), F.col("id")).alias("display_name"), F.lit("Potential").alias("status_label"), F.concat(stamp, F.lit("+00:00")).alias("date_created"), F.concat(stamp, F.lit("+00:00")).alias("date_updated"))
    event = F.struct(
        F.concat(F.lit("ev_"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("id"), stamp.alias("date_created"), stamp.alias("date_updated"), F.lit("lead").alias("object_type"), lead.alias("object_id"), lead.alias("lead_id"),
        F.when(updated, "updated").otherwise("created").alias("action"), F.when(updated, F.array(F.lit("status_label"))).otherwise(F.array().cast("array<string>")).alias("changed_fields"), data.alias("data"),
    )
    made = spark.range(n).withColumn("delivery", F.explode(F.sequence(F.lit(1), F.lit(max(1, repeat)))))
    return made.select(F.to_json(F.struct(F.lit("whsub_test").alias("subscription_id"), event.alias("event"))).alias("body"), "delivery")
