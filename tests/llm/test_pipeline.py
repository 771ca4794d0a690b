"""The pipeline stage by stage against plain restatements of what each must do."""

import corpus_pipeline
import numpy as np
import pytest
from conftest import SMALL
from test_operators import brute_components, brute_runs, n_tokens

from millrace.llm import langid, qualitycrf


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    out, docs = {}, spark.read.parquet(f"{SMALL}/documents.parquet")
    root = tmp_path_factory.mktemp("pipeline")
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{root}/{name}")
        docs = out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_stay(kept):
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert kept[name].columns == kept["documents"].columns


def test_filters_keep_clean_documents(kept, spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good, bad = (ids(labels.where(f"quality = {k}")) for k in (1, 0))
    first = ids(kept["quality_classifier"])
    assert len(good & first) >= 0.95 * len(good) and len(bad & first) <= 0.1 * len(bad)
    assert len(ids(kept["language_id"])) >= 0.98 * len(first)
    model = qualitycrf.fit(kept["documents"], labels)
    scores = qualitycrf.score_documents(kept["documents"], model)
    assert ids(scores.where("predicted = 1")) == first
    known = langid.identify(kept["quality_classifier"], langid.fit(kept["documents"]))
    assert ids(known.where("not rejected")) == ids(kept["language_id"])


def test_line_dedup(kept):
    docs, gone = brute_runs([(r.doc_id, r.text) for r in kept["language_id"].collect()], 50)
    want = {i: "\n".join(x for k, x in enumerate(docs[i]) if k not in gone[i]) for i in docs}
    assert {r.doc_id: r.text for r in kept["line_dedup"].collect()} == want


def test_near_dedup(kept):
    sets = {}
    for r in kept["line_dedup"].collect():
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text).split()
        sets[r.doc_id] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    want = brute_components(sets, 80)
    assert ids(kept["minhash_near_dedup"]) == {i for i, c in want.items() if i == c}


def test_packing_holds_everything(kept):
    p = kept["best_fit_packing"].toPandas()
    size = n_tokens()
    text = {r.doc_id: size(r.text) + 1 for r in kept["minhash_near_dedup"].collect()}
    assert p.groupby("doc_id").length.sum().to_dict() == text
    assert (p.groupby("bin_id").length.sum() <= p.groupby("bin_id").capacity.max()).all()
    assert np.all(p.capacity.isin([1024, 2048, 4096, 8192, 16384]))


def test_run_is_the_stages(spark, kept):
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kept["best_fit_packing"].collect()))
