"""Line dedup: repeated runs of lines are found by prefix doubling over the corpus's line sequences; later copies go.

A run is a sequence of consecutive lines of one document. It goes if an equal run starts at an earlier place, in order of
(doc_id, line number), or of (doc_id, hash of the text, line number) where several rows have a doc_id or none, and if it holds at least ``min_chars`` characters, each line counting its newline. That is so exactly
for the lines that some shortest such run covers: the shortest from a line on, or the shortest up to a line. So only
runs of at most ``min_chars`` lines are compared, however long the repeated runs are.

Suffixes are ranked by prefix doubling: the rank of a suffix at depth 1 stands for its first line, and at depth 2k for its
pair of depth-k ranks k lines apart. A rank is the place of the first suffix of its class, hence an interval of the
suffix array with a longest common prefix of at least that depth is a class, and whoever isn't its head is a later copy. Each level
keeps suffixes with an equal elsewhere only, and only where some shortest run is that long. Runs of other lengths
compare the ranks at two overlapping depths. All of it is aggregation, with map-side combination, and equi-joins on keys
whose hot ones AQE splits; there is no Python.

Cases: null texts stay null and empty texts empty; rows that repeat a doc_id, or have none, are the same place if their texts
are equal, and aren't copies of each other then, and are documents of their own if not; a null doc_id comes after all others; blank lines are lines; an empty table gives an empty
table; all other columns stay as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import cut, free_name, spread

MIN_CHARS = 50
_LAST = 2**63 - 1


def _lines() -> F.Column:
    return F.split(F.col("text"), "\n", -1)


def _id() -> F.Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))


def _key(repeat: bool) -> F.Column:
    """What names a row's text, in the order of places: the doc_id if no other row has it, else along with the text's hashes."""
    return F.struct(F.col("doc_id").isNull().alias("none"), _id().alias("id"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(7), "text").alias("t2")) if repeat else _id()


def repeated_runs(docs: DataFrame, repeat: bool, min_chars: int = MIN_CHARS) -> DataFrame:
    """Maximal runs of lines to delete: d (the row's key), lo and hi (first and last line, from 0)."""
    w = min_chars
    # the constant goes first: columns are hashed in a chain, and behind the line it would make h2 a function of h1
    marks = F.transform(_lines(), lambda s: F.struct(F.xxhash64(s).alias("h1"), F.xxhash64(F.lit(7), s).alias("h2"), F.least(F.length(s) + 1, F.lit(w)).alias("w")))
    lines = docs.where(F.col("text").isNotNull()).select(_key(repeat).alias("d"), F.posexplode(marks).alias("p", "m")).select("d", "p", "m.h1", "m.h2", "m.w")
    lines = cut(lines.distinct() if repeat else lines)
    classes = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("d", "p")).alias("head")).where("n > 1").select("h1", "h2", "head")
    alike = lines.join(spread(classes, "head"), ["h1", "h2"]).select("d", "p", "w", F.col("head.d").alias("hd"), F.col("head.p").alias("hp"))
    island = F.col("p") - F.row_number().over(Window.partitionBy("d").orderBy("p"))
    alike = alike.withColumn("i", island)
    run = Window.partitionBy("d", "i")
    alike = cut(alike.withColumn("e", F.sum("w").over(run.orderBy("p"))))
    # shortest runs of at least w characters from each line on and up to each line
    events = alike.select("d", "i", "p", F.explode(F.array(F.struct((F.col("e") - F.col("w")).alias("at"), F.lit(True).alias("begin")), F.struct(F.col("e").alias("at"), F.lit(False).alias("begin")))).alias("x")).select("d", "i", "p", "x.at", "x.begin")
    by_place = run.orderBy("at")
    ends = F.min(F.when(~F.col("begin"), F.col("p"))).over(by_place.rangeBetween(w, 2 * w))
    begins = F.max(F.when(F.col("begin"), F.col("p"))).over(by_place.rangeBetween(-2 * w, -w))
    spans = events.select("d", "p", "begin", ends.alias("last"), begins.alias("head"))
    spans = spans.select("d", F.when(F.col("begin"), F.col("p")).otherwise(F.col("head")).alias("p"), F.when(F.col("begin"), F.col("last")).otherwise(F.col("p")).alias("q"))
    spans = spans.where("p is not null and q is not null").select("d", "p", (F.col("q") - F.col("p") + 1).alias("m")).distinct()
    spans = cut(spans)
    single = spans.where("m = 1").join(alike.where("d <> hd or p <> hp").select("d", "p"), ["d", "p"], "left_semi")
    longest = spans.agg(F.max("m")).first()[0] or 1
    copies = cut(single.select("d", F.col("p").alias("lo"), F.col("p").alias("hi")))
    ranks, step, level = alike.select("d", "i", "p", "hd", "hp"), 1, []
    while 2 * step <= longest:
        ranks = cut(_double(ranks, step))
        step *= 2
        level.append((step, ranks))
    for depth, ranked in level:
        own = spans.where(f"m >= {depth} and m < {2 * depth}").withColumn("q", F.col("p") + F.col("m") - depth)
        a = ranked.select("d", "p", F.col("hd").alias("ad"), F.col("hp").alias("ap"))
        b = ranked.select("d", F.col("p").alias("q"), F.col("hd").alias("bd"), F.col("hp").alias("bp"))
        own = own.join(a, ["d", "p"]).join(b, ["d", "q"])
        by = ["m", "ad", "ap", "bd", "bp"]
        heads = own.groupBy(*by).agg(F.count("*").alias("n"), F.min(F.struct("d", "p")).alias("head")).where("n > 1").drop("n")
        later = own.join(spread(heads, "head"), by).where("d <> head.d or p <> head.p")
        # cut here too: a plan of all levels at once would be hundreds of stages that the driver holds together
        copies = copies.union(cut(later.select("d", F.col("p").alias("lo"), (F.col("p") + F.col("m") - 1).alias("hi"))))
    # overlapping and touching runs together are maximal runs
    order = Window.partitionBy("d").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    merged = copies.withColumn("new", F.coalesce((F.col("lo") > reach + 1).cast("int"), F.lit(1))).withColumn("g", F.sum("new").over(order))
    return merged.groupBy("d", "g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).select("d", "lo", "hi")


def _may_repeat(docs: DataFrame) -> bool:
    """Whether two rows have the same doc_id, null counting as the largest."""
    return not docs.groupBy(_id().alias("id")).count().where("count > 1").isEmpty()


def _double(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks at depth 2 * step of the suffixes that have an equal at that depth."""
    # within an island the row step places on is the suffix step lines on, unless a suffix between has no equal
    next_ = ranks.select("d", (F.col("p") - step).alias("p"), F.col("hd").alias("nd"), F.col("hp").alias("np"))
    pairs = ranks.join(next_, ["d", "p"])
    by = ["hd", "hp", "nd", "np"]
    heads = pairs.groupBy(*by).agg(F.count("*").alias("n"), F.min(F.struct("d", "p")).alias("head")).where("n > 1").drop("n")
    return pairs.join(spread(heads, "head"), by).select("d", "i", "p", F.col("head.d").alias("hd"), F.col("head.p").alias("hp"))


def _with_kept(docs: DataFrame, min_chars: int) -> tuple[DataFrame, str]:
    """docs with the deleted runs of each row, in order, null if none, and the name of that column."""
    repeat = _may_repeat(docs)
    key, gone = (free_name(docs, n) for n in ("__key", "__gone"))
    runs = repeated_runs(docs, repeat, min_chars).groupBy(F.col("d").alias(key)).agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias(gone))
    return docs.withColumn(key, _key(repeat)).join(runs, key, "left"), gone


def _rest(gone: str) -> F.Column:
    """The text without the deleted runs: the slices between them."""
    lines, gone = _lines(), F.col(gone)
    after = F.transform(gone, lambda g, i: F.struct((g["hi"] + 2).alias("from"), F.coalesce(F.get(gone, i + 1)["lo"], F.size(lines)).alias("to")))
    spans = F.concat(F.array(F.struct(F.lit(1).alias("from"), gone[0]["lo"].alias("to"))), after)
    kept = F.flatten(F.transform(spans, lambda s: F.slice(lines, s["from"], F.greatest(s["to"] - s["from"] + 1, F.lit(0)))))
    return F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))


def remove_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """docs, all columns, with text less its later copies of repeated runs; a text of nothing else becomes empty."""
    names = docs.columns
    found, gone = _with_kept(docs, min_chars)
    return found.select(*[_rest(gone).alias("text") if c == "text" else F.col(c) for c in names])


def digest(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, n_lines, n_deleted, n_runs (maximal deleted runs) and text_md5 of what is left."""
    found, gone = _with_kept(docs.select("doc_id", "text"), min_chars)
    size = F.aggregate(gone, F.lit(0), lambda s, g: s + g["hi"] - g["lo"] + 1)
    return found.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines())).cast("long").alias("n_lines"),
        F.coalesce(size, F.lit(0)).cast("long").alias("n_deleted"),
        F.coalesce(F.when(F.col(gone).isNotNull(), F.size(gone)), F.lit(0)).cast("long").alias("n_runs"),
        F.md5(_rest(gone)).alias("text_md5"),
    )
