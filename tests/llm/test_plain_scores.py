"""The scoring queries over whole tables against plain Python: dictionaries, loops and one forward-backward pass a text, with the model that the query fits."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL

from millrace.llm import langid, qualitycrf, queries, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def small(spark):
    return {t: spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels")}


@pytest.fixture(scope="module")
def texts(small):
    return {r.doc_id: r.text for r in small["documents"].select("doc_id", "text").collect()}


def log_sum(a, b):
    top = max(a, b)
    return top + math.log(math.exp(a - top) + math.exp(b - top))


def plain_marginals(crf, rows):
    """P(state 1) of each row by sums of logarithms."""
    e = [sum(w * (x - m) / s for w, x, m, s in zip(crf.w, row, crf.mean, crf.scale)) + crf.b for row in rows]
    if not e:
        return []
    fore = [[crf.start[0], crf.start[1] + e[0]]]
    for v in e[1:]:
        a, b = fore[-1]
        fore.append([log_sum(a + crf.trans[0, 0], b + crf.trans[1, 0]), v + log_sum(a + crf.trans[0, 1], b + crf.trans[1, 1])])
    back = [[0.0, 0.0]]
    for v in reversed(e[1:]):
        a, b = back[-1]
        back.append([log_sum(crf.trans[0, 0] + a, crf.trans[0, 1] + v + b), log_sum(crf.trans[1, 0] + a, crf.trans[1, 1] + v + b)])
    both = [(f[0] + g[0], f[1] + g[1]) for f, g in zip(fore, reversed(back))]
    return [1.0 / (1.0 + math.exp(min(a - b, 700.0))) for a, b in both]


def plain_quality(crf, text):
    symbols = b"#*$%&|<>{}[]\\^~=@_+"
    own, ink, before = [], [], None
    for line in (text or "").encode().split(b"\n"):
        ws = WORD.findall(line)
        if not ws:
            continue
        n, size = len(ws), sum(map(len, ws))
        same = sum(a == b for a, b in zip([before, *ws], ws))
        before = ws[-1]
        of = lambda ok: sum(map(ok, line)) / size  # noqa: B023, E731
        each = lambda ok: sum(map(ok, ws)) / n  # noqa: B023, E731
        own.append([
            math.log1p(n), of(lambda c: 65 <= c <= 90), of(lambda c: c in symbols), of(lambda c: c == 33), of(lambda c: 48 <= c <= 57), of(lambda c: c >= 128), min(size / n, 40.0) / 10.0, same / n,
            each(lambda w: w[-1] in symbols), each(lambda w: w[-1] in b"!?"), each(lambda w: w[-1] in b".,"), each(lambda w: 65 <= w[0] <= 90), each(lambda w: len(w) == 1),
        ])
        ink.append(size)
    rows = [own[i] + own[max(i - 1, 0)] + own[min(i + 1, len(own) - 1)] for i in range(len(own))]
    p = plain_marginals(crf, rows)
    return sum(a * b for a, b in zip(p, ink)) / sum(ink) if ink else qualitycrf.EMPTY_SCORE


def plain_toxicity(model, text, known):
    edge = b".,;:!?\"'()[]*-_"
    found = []
    for w in WORD.findall((text or "").encode().lower()):  # bytes: A to Z only
        for _ in range(3):
            w = w[:-1] if len(w) > 1 and w[-1] in edge else w
            w = w[1:] if len(w) > 1 and w[0] in edge else w
        if w not in known:
            block = toxicity.TextBlock(pa.array([w], pa.large_binary()).cast(pa.large_string(), safe=False))
            parts = toxicity.part_hashes(block, np.array([0]), np.array([len(w)]))
            known[w] = [dict(zip(k.tolist(), o)).get(int(h[0]), 0.0) for h, k, o in zip(parts, model.keys, model.odds)]
        found.append((known[w], len(w)))
    best = [0.0, *[max(c) for c, _ in found], 0.0]
    rows = [[*c, best[i + 1], best[i], best[i + 2], min(n, 30) / 10.0] for i, (c, n) in enumerate(found)]
    none = 1.0
    for p in plain_marginals(model.crf, rows):
        p = min(max(p, 1e-12), 1 - 1e-12)
        none /= 1.0 + math.exp(model.slope * math.log(p / (1 - p)) + model.shift)
    return 1.0 - none


def plain_language(model, text):
    low = (text or "").encode().lower()
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    b = [c if 97 <= c <= 122 or c >= 128 else 32 for c in low]
    keep = lambda x, shift: ((x & (2**64 - 1)) >> shift) & (langid.DIMS - 1)
    grams = Counter(b)
    grams.update(keep((x * 0x9E3B + y * 0x61C9) * 0x2545F491, 13) for x, y in zip(b, b[1:]))
    grams.update(keep((x * 0x1B873593 + y * 0x3C6EF372 + z * 0x5BD1E995) * 0x27D4EB2F, 17) for x, y, z in zip(b, b[1:], b[2:]))
    v = {g: math.log1p(c) * float(model.idf[g]) for g, c in grams.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    sim = {}
    for cent, of in zip(model.centroids, model.lang_of):
        sim[model.langs[of]] = max(sim.get(model.langs[of], -1.0), sum(x * float(cent[g]) for g, x in v.items()) / norm)
    top = max(sim.values())
    return min(g for g in sim if sim[g] == top), 1.0 / sum(math.exp((s - top) / langid.TEMPERATURE) for s in sim.values())


def test_quality_query(spark, small, texts):
    crf = qualitycrf.fit(small["documents"], small["labels"])
    got = queries.op5_line_crf_quality(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        want = plain_quality(crf, texts[r.doc_id])
        assert r.score == pytest.approx(want, abs=1e-6), r.doc_id
        assert r.predicted == (r.score >= 0.7)


def test_toxicity_query(spark, small, texts):
    model, known = toxicity.fit(small["documents"], small["labels"]), {}
    got = queries.op10_toxic_span_crf(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        assert r.score == pytest.approx(plain_toxicity(model, texts[r.doc_id], known), abs=1e-5), r.doc_id
        assert r.predicted == (r.score >= 0.3)


def test_language_query(spark, small, texts):
    model = langid.fit(small["documents"])
    got = queries.op6_centroid_language_id(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        lang, score = plain_language(model, texts[r.doc_id])
        assert r.score == pytest.approx(score, abs=2e-3), r.doc_id
        assert r.lang_pred == lang or abs(r.score - 0.5) < 2e-3


def test_scores_depend_on_the_text_alone(small, texts):
    """A text scores alike in any company: behind one that ends in its first word, before or after empty ones, cut off from blanks."""
    docs, marks = small["documents"], small["labels"]
    some = ["x", "x", "x x", "", None, "x", "idiot", "idiot", "a\nb", "b\na", "b", "!!", "!! moron", "moron", "é", "é 1", "1"] + [t for t in texts.values() if t is not None][:40]
    crf, tox, lang = qualitycrf.fit(docs, marks), toxicity.fit(docs, marks), langid.fit(docs)
    for of in (lambda t: qualitycrf.scores(crf, t), lambda t: toxicity.scores(tox, t)[0], lambda t: langid.predict(lang, t)[1]):
        alone = [of(pa.array([t], pa.large_string()))[0] for t in some]
        assert of(pa.array(some, pa.large_string())) == pytest.approx(alone, abs=1e-6)  # languages are compared in float32


def test_texts_of_megabytes(small):
    """One word of three megabytes, 600,000 words, 300,000 lines: each scores as plain arithmetic says, and the spans of a late insult are found."""
    docs, marks = small["documents"], small["labels"]
    crf, tox, lang = qualitycrf.fit(docs, marks), toxicity.fit(docs, marks), langid.fit(docs)
    long = ["w" * 3_000_000, "some words " * 300_000, "a line of it\n" * 300_000, "plain words " * 250_000 + "you idiot"]
    at = pa.array(long, pa.large_string())
    assert qualitycrf.scores(crf, at)[:2] == pytest.approx([plain_quality(crf, t) for t in long[:2]], abs=1e-6)
    assert ((p := qualitycrf.scores(crf, at)) >= 0).all() and (p <= 1).all()
    score, spans = toxicity.scores(tox, at)
    assert ((score >= 0) & (score <= 1)).all() and all(s["end"] <= len(t) for t, found in zip(long, spans.to_pylist()) for s in found)
    assert score[3] >= score[1]
    assert set(langid.predict(lang, at)[0]) <= set(lang.langs)
