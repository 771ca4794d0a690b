"""Ids of any size, repeated or missing, and columns with awkward names, through operators and the whole pipeline."""

import glob

import corpus_pipeline
import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_operators import brute_components

from millrace.llm import linededup, neardup, packing, vptree
from millrace.llm.runtime import cut

LARGE = [None, -1, 2**53 + 1, 2**53 + 3, 2**62 + 3, 2**63 - 1, 7, 7]


def test_packing_keeps_ids(spark):
    docs = spark.createDataFrame([(i, f"some words {k}") for k, i in enumerate(LARGE)], "doc_id long, text string").repartition(1)
    got = packing.pack(docs)
    assert got.select("bin_id").distinct().count() == 1
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(LARGE, key=str)


@pytest.fixture(scope="module")
def shifted(spark, tmp_path_factory):
    """sf0.001 with ids beyond 2^60, each fifth null, each seventh row twice, and columns named like the operators' own."""
    root = tmp_path_factory.mktemp("shifted")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    name = F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") + 2**60 + 1)
    twice = docs.union(docs.where("doc_id % 7 = 0")).withColumn("doc_id", name)
    odd = twice.withColumns({n: F.lit("x") for n in ("__gone", "__key", "__d", "__keep", "name", "worded", "bin_id", "length", "predicted", "rejected")})
    odd.write.parquet(f"{root}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").withColumn("doc_id", F.col("doc_id") + 2**60 + 1)
    labels.write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_pipeline_keeps_ids(spark, shifted):
    docs = spark.read.parquet(f"{shifted}/documents.parquet")
    known = {r.doc_id for r in docs.select("doc_id").collect()}
    got = [r.doc_id for r in corpus_pipeline.run(spark, shifted).select("doc_id").collect()]
    assert set(got) <= known and len(set(got)) > 60
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, shifted)
        assert kept.columns == docs.columns
        kept = cut(kept)
    assert sorted(got, key=str) == sorted((r.doc_id for r in packing.pack(kept).collect()), key=str)


def test_pipeline_of_an_empty_table(spark, shifted, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{shifted}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_takes_broken_utf8(spark, tmp_path):
    """Spark's strings may hold bytes that aren't UTF-8, in texts with letters and without."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bad = F.when(F.col("doc_id") % 7 == 3, F.unhex(F.lit("3820FFFEC32039")).cast("string")).when(F.col("doc_id") % 7 == 5, F.concat("text", F.unhex(F.lit("20FF")).cast("string")))
    docs.withColumn("text", F.coalesce(bad, "text")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()}
    assert not {i for i in got if i % 7 == 3} and len({i for i in got if i % 7 == 5}) > 10 and len(got) > 100


def test_one_document_a_group(spark):
    """Copies with equal and with missing ids: one row of each group, the least named; rows without words stay."""
    t = "the sun and the moon and a tree stand over the quiet hill beside an old stone wall in early spring"
    near = t + " again"
    other = "nothing of this kind is found in any of the words before it or after it at all"
    rows = [(None, t), (None, t), (5, t), (5, t), (6, t), (6, other), (None, other), (9, near), (3, None), (None, None), (None, ""), (None, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, name string").repartition(4)
    got = sorted(((r.doc_id, r.text) for r in neardup.keep_one(df).collect()), key=str)
    assert got == sorted([(5, t), (6, other), (3, None), (None, None), (None, ""), (None, "")], key=str)
    large = [(k, w) for k, w in zip(LARGE, [t, near, other, t, other + " x", "a b", "a b", "a b"])]
    sets = {}
    for k, (i, w) in enumerate(large):
        words = w.split()
        sets[(i is None, i or 0, k)] = {tuple(words[j : j + 5]) for j in range(len(words) - 4)} or {tuple(words)}
    want = sorted(str(k[1]) for k, c in brute_components(sets, 80).items() if k == c)
    rows = neardup.keep_one(spark.createDataFrame(large, "doc_id long, text string")).collect()
    assert sorted(str(r.doc_id or 0) for r in rows) == want


def test_line_dedup_takes_any_names(spark):
    long = "this line is quite long enough to be a run of its own, and more"
    df = spark.createDataFrame([(1, long, "a", "b", "c"), (2, "x\n" + long, "a", "b", "c")], "doc_id long, text string, __gone string, __KEY string, d string")
    got = linededup.remove_repeats(df)
    assert got.columns == df.columns and {r.doc_id: r.text for r in got.collect()} == {1: long, 2: "x"}


def brute_neighbours(rows, k):
    out = set()
    for i, x in sorted({(i, x) for i, x in rows if i % 20 == 0}, reverse=True):
        s = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in rows if j != i)
        out = {r for r in out if r[0] != i} | {(i, n, j) for n, (_, j) in enumerate(s[:k], 1)}
    return out


@pytest.mark.parametrize("shard_rows, most", [(8192, 4096), (50, 4096), (30, 2)])
def test_neighbours_of_repeated_queries(spark, monkeypatch, shard_rows, most):
    """A query's id on many near rows: as many of others are found as there are, in one shard, in several, and in leaves dealt to several."""
    monkeypatch.setattr(vptree, "MOST_SHARDS", most)
    rng = np.random.default_rng(4)
    rows = [(20, tuple((np.array([1.0, 0, 0, 0]) + rng.normal(size=4) * 0.01).round(6).tolist())) for _ in range(40)]
    rows += [(k + 21 if k % 60 else 40 + k, tuple(v)) for k, v in enumerate(rng.normal(size=(360, 4)).round(3).tolist())]
    df = spark.createDataFrame([(i, list(x)) for i, x in rows], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank, r.vec_id) for r in vptree.nearest(df, factor=1.0, shard_rows=shard_rows).collect()}
    assert got == brute_neighbours(rows, 20)


def test_checkpoints_go_away(spark):
    """What was cut is removed once nothing uses it."""
    assert spark.sparkContext.getConf().get("spark.cleaner.referenceTracking.cleanCheckpoints") == "true"
    import gc
    import time

    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = set(glob.glob(f"{root}/*"))
    df = cut(spark.range(100))
    assert df.count() == 100 and (mine := set(glob.glob(f"{root}/*")) - before)
    del df
    for _ in range(40):
        gc.collect()
        spark._jvm.System.gc()
        if not mine & set(glob.glob(f"{root}/*")):
            break
        time.sleep(0.25)
    assert not mine & set(glob.glob(f"{root}/*"))
