"""MinHash near-dedup by fast similarity sketches, banding and exact verification.

A text's set holds its distinct word shingles (A-Z lower-cased; a shorter text is one shingle; a text without words is empty
and linked with nothing). Sketch: in round i < t every element is thrown into one of t coordinates and an empty coordinate
keeps the least (i, hash) that falls in; rounds t to 2t-1 throw all elements into coordinate i-t. So every coordinate
is filled, equal coordinates estimate the Jaccard similarity with concentration, and large sets need about one round.

Texts of equal sets form a class, represented by its least doc_id. Classes that agree on a band of coordinates share a bucket.
Each member of a bucket is compared, on its full set, with the bucket's least class only, its head. Members of a head's buckets that
remain in different components are compared too, unless their similarities to the head rule the link out (Jaccard
distance is a metric): few pair by pair, many in blocks. No bucket is capped, and no link between different texts that share
a bucket is lost.

Full sets are compared as sets of 64-bit shingle hashes computed afresh from both texts.

Cases: rows without text or words get n_shingles 0 and their own doc_id as component; a null doc_id can't be linked: its
component is null and kept is true; rows that repeat a doc_id are one document whose links add up and get one component;
extra columns pass by; an empty table gives an empty table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import components
from millrace.llm.runtime import cut, free_name, map_blocks, spread
from millrace.llm.textblock import STEPS, TextBlock, U, distinct_pairs, mix, shingles

BANDS, ROWS = 25, 5
EMPTY = U(2**64 - 1)
#: Open members of a cell that are compared pair by pair; members of a block where there are more.
FEW, BLOCK = 48, 256


def text_sets(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct shingle hashes, ordered by text number and hash."""
    block = TextBlock(text, lower=True)
    s, e, wd = block.words()
    h, d, _ = shingles(block.span_hash(s, e), wd, block.n, size)
    return (*distinct_pairs(h, d), block.n)


def sketch(h: np.ndarray, d: np.ndarray, n: int, t: int) -> np.ndarray:
    """(n, t) fast similarity sketches of the sets given as (hash, set number); rows of empty sets stay EMPTY."""
    out = np.full(n * t, EMPTY, U)
    live_h, live_d = h, d
    for i in range(2 * t):
        if not len(live_h):
            break
        x = mix(live_h ^ mix(np.full(1, i + 1, U) * STEPS[7]))
        value = (U(i) << U(48)) | (x & U(0xFFFFFFFFFFFF))
        cell = ((x >> U(32)) * U(t) >> U(32)).astype(np.int64) if i < t else np.full(len(x), i - t)
        at = live_d * t + cell
        free = (out[at] == EMPTY) if i else slice(None)
        np.minimum.at(out, at[free], value[free])
        if i < 4 or i % 4 == 0:  # the sets that still have free coordinates
            open_ = (out.reshape(n, t) == EMPTY).any(axis=1)[live_d]
            live_h, live_d = live_h[open_], live_d[open_]
    return out.reshape(n, t)


def _sketch_columns(text: pa.Array, size: int, bands: int, rows: int) -> list:
    h, d, n = text_sets(text, size)
    count = np.bincount(d, minlength=n).astype(np.int64)
    sk = sketch(h, d, n, bands * rows).reshape(n, bands, rows)
    key = np.broadcast_to(STEPS[8] * np.arange(1, bands + 1, dtype=U), (n, bands)).copy()
    for r in range(rows):
        key = mix(key + sk[:, :, r] * STEPS[10 + r])
    sums = []
    for seed in (20, 21):
        total = np.concatenate((np.zeros(1, U), np.cumsum(mix(h * STEPS[seed]), dtype=U)))
        end = np.cumsum(count)
        sums.append(mix(total[end] - total[end - count] + count.astype(U) * STEPS[22]).view(np.int64))
    live = count > 0
    flat = key.view(np.int64)[live].reshape(-1)
    off = np.concatenate(([0], np.cumsum(live * bands))).astype(np.int32)
    return [count, sums[0], sums[1], pa.ListArray.from_arrays(off, flat)]


def sketches(docs: DataFrame, size: int = 4, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, s1, s2 (128 bits that name the set), bands."""
    long = T.LongType()
    fields = [T.StructField("n_shingles", long), T.StructField("s1", long), T.StructField("s2", long), T.StructField("bands", T.ArrayType(long))]
    return map_blocks(docs, lambda text: _sketch_columns(text, size, bands, rows), ["doc_id"], fields)


def _texts_of(stars: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and text of all documents that share a bucket with another: every later comparison reads these only."""
    ids = stars.select(F.col("a").alias("doc_id")).union(stars.select(F.col("b").alias("doc_id"))).distinct()
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    return cut(texts.join(ids, "doc_id", "left_semi"))


def _jaccard(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(a, b, common, total): exact intersection and union of each pair of doc_ids. Texts are fetched by shuffled joins whose hot keys AQE splits."""
    both = (
        pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "ta", "tb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 64):
                part = batch.slice(lo, 64)
                left, right = (part.column(i).cast(pa.large_string()) for i in (2, 3))
                h, d, n = text_sets(pa.concat_arrays([left, right]), size)
                n //= 2
                count = np.bincount(d, minlength=2 * n)
                # a hash that both texts of a pair have stands next to itself
                h2, d2 = h, d % n if n else d
                order = np.lexsort((h2, d2))
                h2, d2 = h2[order], d2[order]
                twin = (h2[1:] == h2[:-1]) & (d2[1:] == d2[:-1])
                common = np.bincount(d2[1:][twin], minlength=n)
                union = count[:n] + count[n:] - common
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(common.astype(np.int64)), pa.array(union.astype(np.int64))], ["a", "b", "common", "total"])

    schema = T.StructType([pairs.schema["a"], pairs.schema["b"], T.StructField("common", T.LongType()), T.StructField("total", T.LongType())])
    # a doc_id with several texts links by its best pair
    return both.mapInArrow(run, schema).groupBy("a", "b").agg(F.max_by(F.struct("common", "total"), F.col("common") / F.greatest("total", F.lit(1))).alias("j")).select("a", "b", "j.common", "j.total")


def link(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    sk = cut(sketches(docs, size, bands, rows))
    known = sk.where("n_shingles > 0 and doc_id is not null")
    classes = cut(known.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")))
    members = known.join(classes, ["s1", "s2"]).select("doc_id", "rep")
    reps = known.join(classes.select("s1", "s2", F.col("rep").alias("doc_id")), ["s1", "s2", "doc_id"], "left_semi")
    entries = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("rep"))
    heads = entries.groupBy("key").agg(F.min("rep").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    stars = cut(entries.join(spread(heads, "head", "key"), "key").where("rep <> head").select(F.col("rep").alias("a"), F.col("head").alias("b")).distinct())
    texts = _texts_of(stars, docs)
    checked = cut(_jaccard(stars, texts, size))
    linked = F.expr(f"100 * common >= {percent} * total")
    # a doc_id that stands on several rows joins the classes of all its texts
    twice = members.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("w")).where("v <> w").select("doc_id")
    joins = members.join(twice, "doc_id").where("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    edges = checked.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v")).union(joins)
    first = components(edges)
    reach = 1.0 - percent / 100.0 + 1e-9
    more = _more_links(_open_members(stars, checked, first, reach), texts, size, percent, reach)
    of_class = _merged(first, cut(more))
    whole = members.join(of_class, F.col("rep") == F.col("node"), "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    found = whole.groupBy("doc_id").agg(F.min("component").alias("found"))
    out = sk.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _merged(first: DataFrame, more: DataFrame) -> DataFrame:
    """Components of the first round joined by the second round's links."""
    if more.isEmpty():
        return first
    at = lambda c: first.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    lifted = more.join(at("u"), "u", "left").join(at("v"), "v", "left").select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v"))
    second = cut(components(lifted)).select(F.col("node").alias("component"), F.col("component").alias("top"))
    lone = second.select(F.col("component").alias("node"), F.col("top").alias("component"))
    moved = first.join(second, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return moved.union(lone.join(first.select("node"), "node", "left_anti"))


def _open_members(stars: DataFrame, checked: DataFrame, first: DataFrame, reach: float) -> DataFrame:
    """head, cell, rep, comp, far and n, the size of the cell: members of the buckets of a head, dealt to overlapping cells of
    their distance from it, where a cell holds two components. Two of them can only be linked if they share a cell."""
    known = checked.select(F.col("a").alias("rep"), F.col("b").alias("head"), (1 - F.col("common") / F.greatest("total", F.lit(1))).alias("far"))
    comp = first.select(F.col("node").alias("rep"), "component")
    rows = stars.select(F.col("a").alias("rep"), F.col("b").alias("head")).join(known, ["rep", "head"]).join(comp, "rep", "left")
    cell = F.floor(F.col("far") / reach)
    rows = cut(rows.select("head", "rep", F.coalesce("component", "rep").alias("comp"), "far", F.explode(F.array(cell, cell + 1)).alias("cell")))
    mixed = rows.groupBy("head", "cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    return cut(rows.join(spread(mixed.select("head", "cell", "n"), "n", "cell"), ["head", "cell"]))


def _more_links(members: DataFrame, texts: DataFrame, size: int, percent: int, reach: float) -> DataFrame:
    """(u, v): links between open members of different components. Cells of up to FEW members are compared pair by pair; larger ones in
    pairs of blocks, which give back a link to each component at most."""
    few = members.where(f"n <= {FEW}")
    other = few.select("head", "cell", F.col("rep").alias("b"), F.col("comp").alias("comp_b"), F.col("far").alias("far_b"))
    near = (F.col("rep") < F.col("b")) & (F.col("comp") != F.col("comp_b")) & (F.abs(F.col("far") - F.col("far_b")) <= reach)
    pairs = few.join(other, ["head", "cell"]).where(near).select(F.col("rep").alias("a"), "b").distinct()
    of_few = _jaccard(pairs, texts, size).where(F.expr(f"100 * common >= {percent} * total")).select(F.col("a").alias("u"), F.col("b").alias("v"))
    parts = F.ceil(F.col("n") / BLOCK)
    many = members.where(f"n > {FEW}").withColumn("parts", parts.cast("int")).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    many = many.join(texts.withColumnRenamed("doc_id", "rep"), "rep").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    many = many.select("head", "cell", F.least("block", "o").alias("bi"), F.greatest("block", "o").alias("bj"), "block", "rep", "comp", "far", "text")

    def one(pdf):
        return _block_links(pdf, size, percent, reach)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return of_few.union(many.groupBy("head", "cell", "bi", "bj").applyInPandas(one, f"u {kind}, v {kind}"))


def _block_links(pdf: pd.DataFrame, size: int, percent: int, reach: float) -> pd.DataFrame:
    h, d, n = text_sets(pa.array(pdf["text"].tolist(), pa.large_string()), size)
    _, inverse = np.unique(h, return_inverse=True)
    count = np.bincount(d, minlength=n)
    begin = np.cumsum(count) - count
    rep, comp, far, block = (pdf[c].to_numpy() for c in ("rep", "comp", "far", "block"))
    same = pdf["bi"].iloc[0] == pdf["bj"].iloc[0]
    u, v, flag = [], [], np.zeros(int(inverse.max(initial=-1)) + 1, np.int64)
    for i in np.flatnonzero(block == pdf["bi"].iloc[0]):
        may = (comp != comp[i]) & (np.abs(far - far[i]) <= reach) & (100 * np.minimum(count, count[i]) >= percent * np.maximum(count, count[i]))
        may &= (np.arange(n) > i) if same else (block != block[i])
        j = np.flatnonzero(may)
        if not len(j):
            continue
        own = inverse[begin[i] : begin[i] + count[i]]
        flag[own] = 1
        hits = np.concatenate(([0], np.cumsum(flag[inverse])))
        flag[own] = 0
        common = hits[begin[j] + count[j]] - hits[begin[j]]
        j = j[100 * common >= percent * (count[i] + count[j] - common)]
        j = j[np.unique(comp[j], return_index=True)[1]]
        u += [rep[i]] * len(j)
        v += rep[j].tolist()
    return pd.DataFrame({"u": np.array(u, rep.dtype), "v": np.array(v, rep.dtype)})


def _names(docs: DataFrame) -> F.Column:
    """A name for every text of every doc_id that sorts by doc_id, those without one last, then by two hashes of the text."""
    by_id = F.when(F.col("doc_id").isNull(), "~").otherwise(F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0"))
    return F.concat_ws("-", by_id, F.hex(F.xxhash64("text")), F.hex(F.xxhash64(F.lit(7), "text")))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows, with all their columns, of each group's least doc_id and of documents linked with none.

    Where several rows have a doc_id, or any has none, every text of a doc_id is a document of its own, and of rows that are alike in both one
    stays. Rows without words are linked with nothing, so all of them stay."""
    ids = docs.groupBy("doc_id").count()
    name, worded = (free_name(docs, n) for n in ("name", "worded"))
    if ids.where("doc_id is null or count > 1").isEmpty():
        kept = link(docs, size, percent).where("kept").select(F.col("doc_id").alias(name)).distinct()
        return docs.join(kept, docs["doc_id"] == kept[name], "left_semi")
    rows = docs.withColumn(name, _names(docs))
    kept = link(rows.select(F.col(name).alias("doc_id"), "text"), size, percent).where("kept")
    both = rows.join(kept.select(F.col("doc_id").alias(name), (F.col("n_shingles") > 0).alias(worded)).distinct(), name)
    return both.where(worded).dropDuplicates([name]).unionByName(both.where(~F.col(worded))).select(*docs.columns)
