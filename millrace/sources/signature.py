"""Verification of signed webhooks: HMAC-SHA256 over timestamp and body. The two schemes differ in key decoding and in what is signed, and aren't interchangeable.

``verify_crm`` and ``verify_booking`` judge one request; ``verdict`` says the same of columns with Spark's own functions. The first compare in constant time,
columns don't: nobody can time a row of a batch."""

from __future__ import annotations

import hashlib
import hmac
import re
import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_AGE_SECONDS = 300
#: Names of the headers, what stands between timestamp and body, block size and pads of HMAC-SHA256.
CRM_STAMP, CRM_HASH, BOOKING_BOTH = "Close-Sig-Timestamp", "Close-Sig-Hash", "Calendly-Webhook-Signature"
JOINTS = {"crm": "", "booking": "."}
HMAC_BLOCK, INNER_PAD, OUTER_PAD = 64, 0x36, 0x5C
_INTEGER = r"^\s*[+-]?[0-9]{1,18}\s*$"


def header(headers: Mapping[str, str] | None, name: str) -> str | None:
    """A header by name, whatever its case."""
    return next((v for k, v in (headers or {}).items() if k.lower() == name.lower()), None)


def header_column(headers: str | Column, name: str) -> Column:
    h = F.col(headers) if isinstance(headers, str) else headers
    return F.get(F.map_values(F.map_filter(h, lambda k, _: F.lower(k) == name.lower())), 0)


def _check(key: bytes, stamp: str | None, given: str | None, joint: str, body: str, now: float) -> tuple[bool, str]:
    if not stamp or not given:
        return False, "signature header missing or malformed"
    if not re.match(_INTEGER, stamp):
        return False, "timestamp isn't an integer"
    age = now - int(stamp)
    if abs(age) > MAX_AGE_SECONDS:
        return False, f"timestamp is outside the replay window by its age of {int(age)} s"
    made = hmac.new(key, f"{stamp}{joint}{body}".encode(), hashlib.sha256).hexdigest()
    return (True, "verified") if hmac.compare_digest(made.encode(), given.encode()) else (False, "signatures differ")


def _no_key(required: bool) -> tuple[bool, str]:
    return (False, "a signature is required but no key is configured") if required else (True, "no key is configured; not verified")


def verify_crm(headers: Mapping[str, str] | None, body: str, key: str | None, required: bool = True, now: float | None = None) -> tuple[bool, str]:
    """Hex key; signs timestamp and body run together; hash and timestamp in headers of their own."""
    if not key:
        return _no_key(required)
    try:
        raw = bytes.fromhex(key)
    except ValueError:
        return False, "the signing key isn't hexadecimal"
    return _check(raw, header(headers, CRM_STAMP), header(headers, CRM_HASH), JOINTS["crm"], body, time.time() if now is None else now)


def verify_booking(headers: Mapping[str, str] | None, body: str, key: str | None, required: bool = True, now: float | None = None) -> tuple[bool, str]:
    """Text key; signs "timestamp.body"; both parts in one header "t=...,v1=..."."""
    if not key:
        return _no_key(required)
    given = dict(part.strip().split("=", 1) for part in (header(headers, BOOKING_BOTH) or "").split(",") if "=" in part)
    return _check(key.encode(), given.get("t"), given.get("v1"), JOINTS["booking"], body, time.time() if now is None else now)


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Hexadecimal HMAC-SHA256 of a text. The key's two blocks are literals, so a row costs two hashes inside generated code."""
    block = (hashlib.sha256(key).digest() if len(key) > HMAC_BLOCK else key).ljust(HMAC_BLOCK, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (INNER_PAD, OUTER_PAD))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message.cast("binary")), 256))), 256)


def _part(parts: Column, name: str) -> Column:
    """The value of the last "name=value" among the parts of a header."""
    return F.get(F.transform(F.slice(F.filter(parts, lambda p: p.startswith(f"{name}=")), -1, 1), lambda p: F.substring(p, len(name) + 2, 2**31 - 1)), 0)


def verdict(scheme: str, key: str | None, headers: str | Column, body: str | Column, required: bool = True, now: float | None = None) -> Column:
    """Struct of ok and why for each request; headers are a map, names in any case. ``now`` is the query's time unless given."""
    answer = lambda ok, why: F.struct(F.lit(ok).alias("ok"), (why if isinstance(why, Column) else F.lit(why)).alias("why"))
    if not key:
        return answer(*_no_key(required))
    try:
        raw = bytes.fromhex(key) if scheme == "crm" else key.encode()
    except ValueError:
        return answer(False, "the signing key isn't hexadecimal")
    if scheme == "crm":
        stamp, given = header_column(headers, CRM_STAMP), header_column(headers, CRM_HASH)
    else:
        parts = F.transform(F.split(header_column(headers, BOOKING_BOTH), ","), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
        stamp, given = _part(parts, "t"), _part(parts, "v1")
    text = F.coalesce(F.col(body) if isinstance(body, str) else body, F.lit(""))
    age = (F.current_timestamp().cast("double") if now is None else F.lit(float(now))) - F.when(stamp.rlike(_INTEGER), stamp).try_cast("long")
    missing = (F.coalesce(stamp, F.lit("")) == "") | (F.coalesce(given, F.lit("")) == "")
    stale = F.concat(F.lit("timestamp is outside the replay window by its age of "), age.cast("long").cast("string"), F.lit(" s"))
    return (
        F.when(missing, answer(False, "signature header missing or malformed")).when(age.isNull(), answer(False, "timestamp isn't an integer"))
        .when(F.abs(age) > MAX_AGE_SECONDS, answer(False, stale))
        .when(hmac_sha256(raw, F.concat(stamp, F.lit(JOINTS[scheme]), text)) == given, answer(True, "verified"))
        .otherwise(answer(False, "signatures differ"))
    )


def verified(scheme: str, key: str, now: float | None = None) -> Callable[[str | Column, str | Column], Column]:
    """A check for (headers map, body) columns: a function of two columns that gives a boolean."""
    return lambda headers, body: verdict(scheme, key, headers, body, True, now)["ok"]
