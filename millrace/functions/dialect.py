"""Column helpers where the obvious Spark call differs from the dialect that the tables are defined in.

Nulls come last in every order, ratios are divided once and null for a zero denominator, timestamps are UTC."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The business zone; it observes daylight saving time.
BUSINESS_ZONE = "America/New_York"
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_leaves(raw: str | Column, paths: dict[str, tuple[str, ...]], documents: tuple[str, ...] = ()) -> tuple[Column, dict[str, Column]]:
    """(one parse of ``raw`` as a struct; how to read each path from a column ``__json`` that holds it).

    A leaf is parsed as a variant, which knows a string that looks like an array from an array. A scalar path that holds an object or array gives
    null; those named in ``documents`` give the JSON text. A key may contain dots, for a path is a tuple of keys."""
    tree: dict = {}
    for name, path in paths.items():
        node = tree
        for key in path[:-1]:
            node = node.setdefault(key, {})
        node.setdefault(path[-1], T.StringType() if name in documents else T.VariantType())

    def kind(node) -> T.DataType:
        return node if isinstance(node, T.DataType) else T.StructType([T.StructField(k, kind(v)) for k, v in node.items()])

    out = {}
    for name, path in paths.items():
        leaf = F.col("__json")
        for key in path:
            leaf = leaf.getField(key)
        out[name] = leaf if name in documents else scalar(leaf)
    return F.from_json(col(raw), kind(tree)), out


def json_fields(df: DataFrame, paths: dict[str, tuple[str, ...]], documents: tuple[str, ...] = (), raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and the paths of ``raw``, parsed once a row. The parse goes through a generator, for what is filtered on a plain projection is pushed
    below it and parsed again there, once for each path."""
    parsed, out = json_leaves(raw, paths, documents)
    rows = df.select(*keep, F.explode_outer(F.array(parsed)).alias("__json"))
    return rows.select(*keep, *[c.alias(n) for n, c in out.items()])


def scalar(leaf: Column) -> Column:
    """A variant as text; null for objects, arrays and null."""
    kind = F.schema_of_variant(leaf)
    return F.when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), leaf.cast("string"))


def keys_of(path: str) -> tuple[str, ...]:
    """The keys of a JSONPath such as $.a['b.c'].d."""
    keys = tuple(a or b for a, b in re.findall(r"\.([^.\[\]]+)|\['([^']+)'\]", path))
    if "$" + "".join(f"['{k}']" if f"['{k}']" in path else f".{k}" for k in keys) != path:
        raise ValueError(f"not a path of keys: {path}")
    return keys


def json_scalar(raw: str | Column, path: str) -> Column:
    """A scalar at a JSONPath of keys; null for objects and arrays. For several paths of a text use json_fields, which parses once."""
    leaf, _ = json_leaves(raw, {"v": keys_of(path)})
    for key in keys_of(path):
        leaf = leaf.getField(key)
    return scalar(leaf)


def iso_ts(c: str | Column) -> Column:
    """ISO-8601 text as UTC timestamp; null if it isn't one. Bare years and times of day, which Spark would take, are not."""
    return F.when(col(c).rlike(_ISO), F.try_to_timestamp(col(c)))


def local_ts(ts: str | Column, zone: str | Column = BUSINESS_ZONE) -> Column:
    """The wall clock of a UTC timestamp in a zone; null for a null zone."""
    return F.from_utc_timestamp(col(ts), zone)


def local_date(ts: str | Column, zone: str | Column = BUSINESS_ZONE) -> Column:
    return F.to_date(local_ts(ts, zone))


def known_zone(c: str | Column) -> Column:
    """The zone id if it looks like one that Spark takes, else null; an unknown region would fail the whole build."""
    return F.when(col(c).rlike(r"^(UTC|GMT|Z|[A-Za-z]+(/[A-Za-z0-9_+\-]+)+|[+-]\d{2}:\d{2})$"), col(c))


def iso_dow(ts: str | Column) -> Column:
    """Day of week, 1 is Monday."""
    return (F.weekday(col(ts)) + 1).cast("long")


def hour_of(ts: str | Column) -> Column:
    return F.hour(col(ts)).cast("long")


def week_start(d: str | Column) -> Column:
    """Monday of the week, as a date."""
    return F.trunc(col(d), "week")


def round_to(x: str | Column, n: int) -> Column:
    """Decimal rounding of doubles by scaling, which agrees with engines that round the binary value."""
    scale = F.lit(float(10**n))
    return F.round(col(x).cast("double") * scale, 0) / scale


def ratio(num: str | Column, den: str | Column) -> Column:
    """Null for a zero or null denominator."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def ratio_to(num: str | Column, den: str | Column, n: int) -> Column:
    return round_to(ratio(num, den), n)


def strip(c: str | Column) -> Column:
    """Trim all white space, not just spaces."""
    return F.regexp_replace(F.regexp_replace(col(c), r"^\s+", ""), r"\s+$", "")


def norm_email(c: str | Column) -> Column:
    return F.lower(strip(c))


def not_blank(c: str | Column) -> Column:
    return col(c).isNotNull() & (strip(c) != "")


def greatest_strict(*cols: Column) -> Column:
    """Null if any argument is null."""
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    return F.when(known, F.greatest(*cols))


def first_match(c: str | Column, pattern: str, group: int = 1) -> Column:
    """Null, not an empty string, if nothing matches."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def stem(path: str | Column, suffix: str = ".json") -> Column:
    return first_match(path, r"/([^/]+)" + suffix.replace(".", r"\.") + "$")


def last_segment(uri: str | Column) -> Column:
    """What follows the last slash, not counting trailing ones; null if that is nothing."""
    return F.nullif(F.element_at(F.split(F.regexp_replace(col(uri), "/+$", ""), "/"), -1), F.lit(""))


def desc(c: str | Column) -> Column:
    return col(c).desc_nulls_last()


def asc(c: str | Column) -> Column:
    return col(c).asc_nulls_last()


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in a total order. Spark bounds the group before the shuffle (WindowGroupLimit)."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).where("__rn = 1").drop("__rn")


def ranked(df: DataFrame, by: Column, name: str, buckets: int = 64) -> DataFrame:
    """df with rank() by a number, ascending and nulls last, without bringing all rows into one partition.

    Distinct values are counted, so ties however many are one row, and dealt to buckets by quantiles of them; a value's rank is one more than the rows of
    lower buckets and of lower values in its own. What meets in one place is a row a bucket. Values equal a border are in the bucket below it,
    so a bucket has all rows of a value."""
    rows = df.withColumn("__v", by.cast("double"))
    counts = rows.groupBy("__v").agg(F.count("*").alias("__n"))
    shares = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
    borders = counts.agg(F.percentile_approx("__v", shares, 100 * buckets).alias("__borders"))
    below = F.size(F.filter("__borders", lambda x: x < F.col("__v")))
    dealt = counts.crossJoin(borders).select("__v", "__n", F.when(F.col("__v").isNull(), buckets).otherwise(below).alias("__b"))
    sums = dealt.groupBy("__b").agg(F.sum("__n").alias("__n")).agg(F.collect_list(F.struct("__b", "__n")).alias("__sums"))
    before = F.aggregate(F.filter("__sums", lambda s: s["__b"] < F.col("__b")), F.lit(0).cast("long"), lambda a, s: a + s["__n"])
    own = F.sum("__n").over(Window.partitionBy("__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1))
    ranks = dealt.crossJoin(sums).select(F.col("__v").alias("__w"), (before + F.coalesce(own, F.lit(0).cast("long")) + 1).alias(name))
    return rows.join(ranks, rows["__v"].eqNullSafe(ranks["__w"])).drop("__v", "__w")
