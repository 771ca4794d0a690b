"""Each operator's query against brute force on whole small tables, and every awkward case on a table of its own."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from millrace.llm import langid, linededup, neardup, packing, pieces, qualitycrf, qualityrules, queries, tokencounts, toxicity, training, vptree
from millrace.llm.components import components
from millrace.llm.textblock import TextBlock

ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, d string, component_id string, capacity string, held_out string, `k0` string"


def odd_rows():
    rng = random.Random(4)
    words = ["the", "of", "and", "sun", "moon", "ü", "tree", "x1"]
    say = lambda n: " ".join(rng.choices(words, k=n))
    base = say(120)
    passage = "this very line of text stands in several documents, word for word, and is long enough"
    texts = [
        (1, None), (2, ""), (3, " \n\t\n"), (4, base), (5, base), (6, base.replace("sun", "Sun")), (7, base + " end"), (7, base + " end"), (None, base), (None, None), (8, "x"), (9, "x"), (10, "x\n" * 40), (11, "word " * 30_000),
        (12, passage + "\n" + say(30)), (13, say(20) + "\n" + passage), (14, passage), (14, say(40)), (15, "#$% &*| <>" * 20), (16, "a\nb\nc\n" * 15), (17, "a\nb\nc\n" * 15), (18, "123 456"),
    ]
    return [(i, t, None if k % 4 == 0 else "en", None, k, 0.5, "kept", "d", "c", "cap", "h", "k") for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def small(spark):
    return {t: spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels", "embeddings")}


@pytest.fixture(scope="module")
def larger(spark):
    """Enough documents of each language for references of their own."""
    return {t: spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels")}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")


def sql_rows(name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con.execute(queries.SQL[name]).df()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    got, want = queries.QUERIES[name](spark, SMALL).toPandas(), sql_rows(name)
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    text = lambda df: sorted(tuple(map(str, r)) for r in df[cols].astype(object).itertuples(index=False))
    assert text(got) == text(want)


def brute_runs(rows, w):
    """Lines to delete of each doc_id: those in a run of at least w characters of which an equal run starts earlier."""
    docs = {}
    for i, t in rows:
        if t is not None:
            docs.setdefault(2**63 - 1 if i is None else i, t.split("\n"))
    first, gone = {}, {i: set() for i in docs}
    for i in sorted(docs):
        for a in range(len(docs[i])):
            run, size = "", 0
            for b in range(a, len(docs[i])):
                run, size = run + docs[i][b] + "\n", size + len(docs[i][b]) + 1
                if size >= w:
                    if first.setdefault(run, (i, a)) != (i, a):
                        gone[i] |= set(range(a, b + 1))
    return docs, gone


def test_line_dedup_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, "\n".join(rng.choices(["a", "bb", "ccc ccc", "", "dd d", "a long line of its own"], k=rng.randint(0, 14)))) for i in range(40)]
    docs, gone = brute_runs(rows, 20)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.remove_repeats(df, 20).collect()}
    assert got == {i: "\n".join(x for k, x in enumerate(docs[i]) if k not in gone[i]) for i in docs}
    assert any(gone.values())


def test_line_dedup_odd(odd, none):
    out = linededup.remove_repeats(odd).collect()
    assert len(out) == odd.count() and linededup.remove_repeats(odd).columns == odd.columns
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r.text)
    assert None in by[1] and by[2] == [""] and by[5] == [""] and by[7][0] == by[7][1] and by[17] == [""] and len(by[4][0]) > 50
    assert "this very line" in by[12][0] and "this very line" not in by[13][0]
    assert linededup.digest(none).count() == 0 and linededup.remove_repeats(none).count() == 0


def test_line_dedup_tells_texts_of_one_id_apart(spark, odd):
    """A run that goes from one row doesn't take the same line numbers of another with the same doc_id, or without one too."""
    own = {r.text for r in linededup.remove_repeats(odd).where("doc_id = 14").collect()}
    assert own == {"", odd_rows()[17][1]}
    last = 2**63 - 1
    copied = "\n".join(f"line number {k} of the passage that is copied" for k in range(4))
    mine = [f"nothing like text {k}, at all, anywhere, in any other row of this table" for k in range(4)]
    rows = [(1, copied), (None, copied), (None, mine[0]), (None, mine[1] + "\n" + copied), (None, None), (2, copied), (2, mine[2]), (last, mine[3]), (last, copied)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.text) for r in linededup.remove_repeats(df).collect()}
    assert got == {(1, copied), (None, ""), (None, mine[0]), (None, mine[1]), (None, None), (2, ""), (2, mine[2]), (last, mine[3]), (last, "")}
    assert linededup.digest(df).agg(F.sum("n_deleted")).first()[0] == 16


def test_line_dedup_brute_force_of_rows_with_equal_ids(spark):
    rng = random.Random(10)
    rows = [(rng.choice([None, 1, 2]), "\n".join([f"row {i}"] + [rng.choice(["a", "bb", "ccc ccc", "", "dd d", "a long line of its own"]) for _ in range(rng.randint(0, 14))])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = [r.text for r in df.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text")).collect()]
    docs, gone = brute_runs(list(enumerate(order)), 20)
    want = sorted("\n".join(x for k, x in enumerate(docs[i]) if k not in gone[i]) for i in docs)
    assert sorted(r.text for r in linededup.remove_repeats(df, 20).collect()) == want


def chained_xxhash64(seed, value):
    """Spark's hash of an int behind a column whose hash is seed."""
    m = 2**64 - 1
    h = (seed + 0x27D4EB2F165667C5 + 4) & m ^ (value * 0x9E3779B185EBCA87 & m)
    h = ((h << 23 | h >> 41) & m) * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9 & m
    h = (h ^ h >> 33) * 0xC2B2AE3D27D4EB4F & m
    h = (h ^ h >> 29) * 0x165667B19E3779F9 & m
    h ^= h >> 32
    return h - 2**64 if h >= 2**63 else h


def test_line_hashes_are_two(spark, monkeypatch):
    """h2 of a line isn't the hash of a constant behind h1."""
    df = spark.createDataFrame([(1, "some line"), (2, "another")], "doc_id long, text string")
    for h1, chained in df.select(F.xxhash64("text"), F.xxhash64("text", F.lit(7))).collect():
        assert chained_xxhash64(h1, 7) == chained
    seen = []
    monkeypatch.setattr(linededup, "cut", lambda d, own=linededup.cut: seen.append(d) or own(d))
    linededup.repeated_runs(df, False)
    assert not [r for r in seen[0].collect() if chained_xxhash64(r.h1, 7) == r.h2]


def test_near_dedup_odd(odd, none):
    rows = neardup.link(odd, 4).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id, r.kept))
    assert by[1] == {(0, 1, True)} and by[2] == {(0, 2, True)} and {x[1] for x in by[5] | by[6] | by[7]} == {4} and all(c is None and k for _, c, k in by[None])
    assert by[9] == {(1, 8, False)} and by[17] == {(3, 16, False)}
    assert neardup.link(none).count() == 0
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {1, 2, 4, 8, None} and not {5, 6, 7, 9, 17} & {r.doc_id for r in kept.collect()}


def brute_components(sets, percent):
    ids = sorted(sets)
    top = {i: i for i in ids}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_near_dedup_group_of_near_copies(spark, monkeypatch):
    """Many edited copies of one text, some too far from the rest: blocks and pairs give what all pairs give."""
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 500)}" for _ in range(150)]
    rows = []
    for i in range(160):
        t = list(base)
        for _ in range(rng.randint(0, 9)):
            t[rng.randrange(150)] = f"e{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k : k + 4]) for k in range(147)} for i, t in rows}
    want = brute_components(sets, 80)
    for few, block in ((48, 256), (0, 32)):
        monkeypatch.setattr(neardup, "FEW", few)
        monkeypatch.setattr(neardup, "BLOCK", block)
        assert {r.doc_id: r.component_id for r in neardup.link(df, 4).collect()} == want
    assert len(set(want.values())) > 3


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + k: 100 for k in range(50)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_token_counts(spark, small, odd, none):
    path, pattern = tokencounts.default_vocabulary()
    with open(path, "rb") as f:
        enc = tokencounts.encoder(f.read(), pattern)
    sizes = sorted(len(enc.encode_ordinary(r.text or "")) for r in small["documents"].collect())
    sums = tokencounts.counted(small["documents"])
    got = {r.length: r for r in sums.collect()}
    assert sorted(got) == sorted(set(sizes))
    for n, r in got.items():
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.docs_below, r.tokens_below, r.truncated_total) == (sizes.count(n), sum(s >= n for s in sizes), sum(s for s in sizes if s >= n), sum(s < n for s in sizes), sum(s for s in sizes if s < n), sum(min(s, n) for s in sizes))
    for limit in (0, 100, 777, 10**6):
        r = tokencounts.at_limit(sums, limit).first()
        assert (r.n_docs, r.n_tokens, r.docs_over, r.truncated_total) == (len(sizes), sum(sizes), sum(s > limit for s in sizes), sum(min(s, limit) for s in sizes))
    assert tokencounts.quantile(sums, 0.5) == sizes[-(-len(sizes) // 2) - 1] and tokencounts.quantile(sums, 1.0) == sizes[-1]
    assert tokencounts.counted(odd).agg(F.sum("n_docs")).first()[0] == odd.count()
    assert tokencounts.counted(none).count() == 0 and tokencounts.quantile(tokencounts.counted(none), 0.5) is None


def test_quality_rules(larger, odd, none):
    out = qualityrules.judge(larger["documents"]).join(larger["labels"], "doc_id").toPandas()
    clean = out[(out.quality == 1) & ~out.base_failed]
    assert (clean.kept.mean() > 0.98) and (~out[out.quality == 0].kept).mean() > 0.7
    assert not (out.kept & out.base_failed).any()
    r = {x.doc_id: x for x in qualityrules.judge(odd).collect()}
    assert (r[1].n_words, r[1].base_failed, r[1].kept) == (0, True, False) and r[11].n_words == 30_000 and r[11].base_failed
    assert qualityrules.judge(none).count() == 0 and qualityrules.judge(odd).count() == odd.count()


def brute_rules(rows, least=qualityrules.MIN_DOCS):
    """doc_id -> (kept, character distance, word distance), by dictionaries and one document after the other."""
    q = qualityrules
    words = lambda t: re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    def order(w):
        block = TextBlock(pa.array([w], pa.large_string()))
        return int(block.span_hash(block.off[:1], block.off[1:]).view(np.int64)[0])

    def top(group):
        df = Counter(w for _, _, t in group for w in set(words(t)))
        return sorted(df, key=lambda w: (-df[w], order(w)))[: q.N_COMMON]

    def chars(t):
        named = q._CLASSES[:10]
        sets = ["".join(map(chr, range(ord(c[0]), ord(c[2]) + 1))) if len(c) == 3 and c[1] == "-" else c for c in named]
        return Counter(next((i for i, s in enumerate(sets) if c in s), 10 if c < "\x80" else 11) for c in t or "")

    def distance(p, q):
        a, b = sum(p.values()), sum(q.values())
        if not a or not b:
            return 0.0
        p, q = ({k: v / s for k, v in x.items()} for x, s in ((p, a), (q, b)))
        half = lambda x: sum(v * np.log2(v / ((p.get(k, 0) + q.get(k, 0)) / 2)) for k, v in x.items() if v)
        return max(0.0, (half(p) + half(q)) / 2) ** 0.5

    size = Counter(lang for _, lang, _ in rows)
    group = {i: lang if lang is not None and size[lang] >= least else None for i, lang, _ in rows}
    common = {g: top([r for r in rows if g is None or r[1] == g]) for g in {*group.values(), None}}
    ch = {i: chars(t) for i, _, t in rows}
    hist = lambda t, g: Counter(w if w in common[g] else None for w in words(t))
    wd = {i: hist(t, group[i]) for i, _, t in rows}
    add = lambda many: sum(many, Counter())
    base = {i: len(words(t)) < 20 or 100 * q.measure(pa.array([t], pa.large_string()))[4][0] > 30 * len(words(t)) for i, _, t in rows}

    def refs(ids):
        made = {}
        for g in {group[i] for i in ids} - {None}:
            mine = [i for i in ids if group[i] == g]
            made[g] = (len(mine), add(ch[i] for i in mine), add(wd[i] for i in mine))
        return made, add(ch[i] for i in ids)

    ids = [i for i, _, _ in rows]
    pooled = add(hist(t, None) for _, _, t in rows)
    ref, every = refs(ids)
    first = {i: distance(ch[i], ref[group[i]][1] if group[i] in ref else every) for i in ids}
    again, every = refs([i for i in ids if not base[i] and first[i] <= q.TRIM])
    ref |= {g: x for g, x in again.items() if x[0] >= least}
    out = {}
    for i, _, t in rows:
        _, c, w = ref.get(group[i], (0, every, pooled))
        dc, dw, n, m = distance(ch[i], c), distance(wd[i], w), len(t or ""), sum(wd[i].values())
        far = n >= q.MIN_CHARS and dc > q.CHAR_LIMIT + q.CHAR_WIDEN / n**0.5 or m >= q.MIN_WORDS and dw > q.WORD_LIMIT + q.WORD_WIDEN / m**0.5
        out[i] = (not base[i] and not far, dc, dw)
    return out


def test_quality_rules_against_brute_force(spark, larger):
    """Languages of their own, one with too few documents, one whose documents are all far from each other, and none."""
    rows = [(r.doc_id, r.lang, r.text) for r in larger["documents"].limit(500).collect()]
    rows = [(i, "xx" if i % 50 == 0 else None if i % 11 == 0 else lang, t) for i, lang, t in rows]
    rows += [(10_000 + k, "yy", chr(97 + k % 5) * 300 + " 12345 " * (k * 7)) for k in range(30)] + [(11_000, "en", None), (11_001, "en", "")]
    got = {r.doc_id: (r.kept, r.char_distance, r.word_distance) for r in qualityrules.judge(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)).collect()}
    want = brute_rules(rows)
    assert got.keys() == want.keys() and {x[0] for x in got.values()} == {True, False}
    for i, (kept, dc, dw) in want.items():
        assert got[i][0] == kept and got[i][1:] == pytest.approx((dc, dw), abs=1e-9), i


def test_quality_rules_many_languages(spark, monkeypatch):
    """Every language has references of its own, however many there are, and whether their table is broadcast or not."""
    rows = [(k, f"l{k % 250}", " ".join(f"w{k % 250}_{(k // 250 + j) % 70}" for j in range(60))) for k in range(250 * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    kept = lambda: {r.doc_id: (r.kept, r.word_distance) for r in qualityrules.judge(docs).collect()}
    wide = kept()
    monkeypatch.setattr(qualityrules, "BROADCAST_ROWS", 0)
    assert kept() == wide and len(wide) == 5000 and all(d < 0.5 for _, d in wide.values())


def test_quality_rules_drop_junk(spark):
    """Of labelled documents that the base rules leave: word lists and the like go, clean ones stay."""
    docs, labels = (spark.read.parquet(f"{SMALL.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    out = qualityrules.judge(docs).where("not base_failed").join(labels, "doc_id").select("quality", "kept").toPandas()
    assert out.kept[out.quality == 0].mean() < 0.12 and out.kept[out.quality == 1].mean() > 0.998


def n_tokens():
    path, pattern = tokencounts.default_vocabulary()
    with open(path, "rb") as f:
        enc = tokencounts.encoder(f.read(), pattern)
    return lambda text: len(enc.encode_ordinary(text or ""))


def test_equal_rows_are_dealt_to_many_shards(spark):
    same = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"))
    p = packing.pack(same, capacities=(8, 64), shard_rows=100).toPandas()
    shards = (p.bin_id.to_numpy() >> 32)
    assert len(p) == 3000 and p.length.nunique() == 1 and len(set(shards)) == 30 and np.bincount(shards).max() < 200


def test_packing_query_against_a_plain_one(small):
    """Every shard of the query's result, packed again with plain lists and linear scans."""
    p = packing.pack(small["documents"], capacities=(64, 256, 1024), shard_rows=50).toPandas()
    p["shard"] = p.bin_id // 2**32
    cost = lambda c: packing.OVERHEAD + c + c * c / packing.ATTENTION
    for _, g in p.groupby("shard"):
        items = sorted(g.length.tolist(), reverse=True)
        best = None
        for top in (64, 256, 1024):
            sizes = [c for c in (64, 256, 1024) if c <= top]
            if items[0] > top:
                continue
            bins, rest = [], sum(items)
            for x in items:
                fit = [b for b in bins if b[0] - b[1] >= x]
                if fit:
                    min(fit, key=lambda b: b[0] - b[1])[1] += x
                else:
                    bins.append([min((c for c in sizes if c >= x), key=lambda c: cost(c) / min(c, rest)), x])
                rest -= x
            total = sum(cost(min(c for c in (64, 256, 1024) if c >= used)) for _, used in bins)
            best = total if best is None else min(best, total)
        assert g.drop_duplicates("bin_id").capacity.map(cost).sum() == pytest.approx(best)


def test_packing_is_near_the_optimum():
    """Of all partitions of few items, the cheapest; best-fit is never below it and never far above."""

    def partitions(items):
        if not items:
            yield []
            return
        for rest in partitions(items[1:]):
            yield [[items[0]], *rest]
            for k in range(len(rest)):
                yield rest[:k] + [[items[0], *rest[k]]] + rest[k + 1 :]

    rng, caps = random.Random(6), (100, 200, 400)
    least = lambda n: packing.cost(min(c for c in caps if c >= n))
    for _ in range(40):
        items = sorted((rng.randint(1, 300) for _ in range(rng.randint(1, 6))), reverse=True)
        optimum = min(sum(least(sum(b)) for b in part) for part in partitions(items) if all(sum(b) <= caps[-1] for b in part))
        got = sum(map(packing.cost, packing.pack_lengths(items, caps)[2]))
        assert optimum - 1e-6 <= got <= 1.35 * optimum


def test_packing(spark, small, odd, none):
    for docs in (small["documents"], odd):
        size = n_tokens()
        want = sorted((r.doc_id is None, r.doc_id or 0, size(r.text) + 1) for r in docs.collect())
        p = packing.pack(docs, shard_rows=64).toPandas()
        assert p.length.sum() == sum(w[2] for w in want)
        for _, g in p.groupby("bin_id"):
            g = g.sort_values("bin_offset")
            assert (g.bin_offset.to_numpy() == np.concatenate(([0], np.cumsum(g.length)[:-1]))).all() and g.length.sum() <= g.capacity.iloc[0] and g.capacity.nunique() == 1
        assert sorted(p.columns) == ["bin_id", "bin_offset", "capacity", "doc_id", "length", "piece", "start"]
    whole = packing.pack(small["documents"]).toPandas()
    assert whole.length.sum() / whole.drop_duplicates("bin_id").capacity.sum() > 0.95
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize(("module", "label"), [(qualitycrf, "quality"), (toxicity, "toxic")])
def test_classifiers(small, odd, none, labels, module, label):
    docs, marks = small["documents"], small["labels"]
    model = module.fit(docs, marks)
    out = module.score_documents(docs, model).toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all() and out.score.between(0, 1).all()
    seen = out.merge(marks.toPandas(), on="doc_id")
    right = (seen.predicted == seen[label])
    assert right[~seen.held_out].mean() > 0.9 and right[seen.held_out].mean() > 0.85
    again = module.score_documents(docs.withColumn("lang", F.lit("zz")).withColumn("doc_id", F.col("doc_id") + 4000), model).toPandas()
    assert sorted(again.score) == pytest.approx(sorted(out.score))
    res = module.score_documents(odd, model).toPandas()
    assert len(res) == odd.count() and res.score.between(0, 1).all()
    assert module.score_documents(none, model).count() == 0
    assert module.fit(none, labels) is None and module.score_documents(odd, None).count() == odd.count()
    if label == "quality":
        assert qualitycrf.keep_good(odd, model).columns == odd.columns
        good, bad = (docs.join(marks.where(f"quality = {k} and toxic = 0"), "doc_id").select("text").first().text for k in (1, 0))
        assert np.mean([p for _, p in qualitycrf.line_labels(model, good)]) > 0.7 > np.mean([p for _, p in qualitycrf.line_labels(model, bad)])
    else:
        s = toxicity.spans(model, "you are an IDIOT, moron and pathetic clown.")
        assert any("IDIOT" in x[2] or "moron" in x[2] for x in s) and all(a < b for a, b, _, _ in s)


def test_one_insult_is_enough(larger):
    docs, marks = larger["documents"], larger["labels"]
    model = toxicity.fit(docs, marks)
    texts = ["worthless", "You are worthless.", "The onen ther of the idiot in ering and then.", "This text is pathetic and nothing else is.", "The onen ther of the ering in and then."]
    score = toxicity.scores(model, pa.array(texts, pa.large_string()))[0]
    assert (score[:4] >= toxicity.THRESHOLD).all() and score[4] < toxicity.THRESHOLD
    seen = toxicity.score_documents(docs, model).join(marks.where("toxic = 0"), "doc_id")
    assert seen.agg(F.avg("predicted")).first()[0] < 0.01


def test_all_spans_are_found(larger):
    model = toxicity.fit(larger["documents"], larger["labels"])
    text = "Ö you are an idiot, moron and that was all, but then again: worthless."
    found = toxicity.spans(model, text)
    assert [x[2] for x in found] == ["idiot, moron", "worthless"] and all(text[a:b] == w and p >= 0.5 for a, b, w, p in found)


def test_noisy_or_is_the_plain_product(small):
    """The score against a product over tokens, and its calibration against a scan of the likelihood."""
    model = toxicity.fit(small["documents"], small["labels"])
    texts = [r.text for r in small["documents"].where("text is not null").limit(20).collect()]
    got = toxicity.scores(model, pa.array(texts, pa.large_string()))[0]
    for t, s in zip(texts, got):
        none = 1.0
        for p in toxicity.token_marginals(model, toxicity.TextBlock(pa.array([t], pa.large_string()), lower=True))[3]:
            p = min(max(p, 1e-12), 1 - 1e-12)
            none *= 1 - 1 / (1 + np.exp(-(model.slope * np.log(p / (1 - p)) + model.shift)))
        assert s == pytest.approx(1 - none, abs=1e-9)
    rng = np.random.default_rng(3)
    of = np.repeat(np.arange(3000), 4)
    odds = rng.normal(-4, 4, len(of))
    none = np.exp(-np.bincount(of, np.logaddexp(0, 1.5 * odds - 2.0), 3000))
    slope, shift = toxicity.noisy_or(odds, of, np.ones(len(of)), rng.random(3000) > none)
    assert slope == pytest.approx(1.5, abs=0.4) and shift == pytest.approx(-2.0, abs=0.6)


@pytest.mark.parametrize("module", [qualitycrf, toxicity])
def test_training_sample_is_bounded(spark, module):
    """Rows that repeat one id are one text of the sample; the least hashes of each label are taken."""
    label = "quality" if module is qualitycrf else "toxic"
    docs = spark.createDataFrame([(i % 5 if i < 400 else i, f"text {i}") for i in range(600)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2, i % 2) for i in range(600)], "doc_id long, quality int, toxic int")
    rows = training.labelled_sample(docs, marks, label, 40, 100).toPandas()
    assert rows.doc_id.is_unique and rows.groupby("y").size().between(10, 40).all() and not any(zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id)


def test_language_sample_is_bounded(spark, monkeypatch):
    rows = [(1, f"text {i}", "en") for i in range(500)] + [(i, f"texte {i}", "fr") for i in range(1000, 1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.sample(docs, 30, 100, 10).toPandas()
    assert (got.lang == "en").sum() == 1 and (got.lang == "fr").sum() == 30
    with pytest.raises(ValueError, match="max_langs"):
        langid.sample(docs, 30, 100, 1)


def test_language_against_plain_arithmetic(spark):
    """Centroids, IDF and cosine of a tiny model, by sums over dictionaries."""
    texts = ["aab ba", "ab aab", "ba ab", "xyz zx", "zzx xy", "yx zz"]
    lang = ["p"] * 3 + ["q"] * 3
    model = langid.fit_texts(pa.array(texts, pa.large_string()), lang, centroids=1)
    c = np.array([langid.counts(langid.TextBlock(pa.array([t], pa.large_string())))[0] for t in texts])
    for t, row in zip(texts, c):
        assert row.sum() == len(t) + max(0, len(t) - 1) + max(0, len(t) - 2)
    idf = [np.log(7.0 / (1.0 + sum(row[j] > 0 for row in c))) + 1.0 for j in range(langid.DIMS)]
    unit = lambda v: v / np.sqrt(sum(x * x for x in v))
    vec = [unit(np.array([np.log(1.0 + row[j]) * idf[j] for j in range(langid.DIMS)])) for row in c]
    cents = [unit(sum(vec[:3])), unit(sum(vec[3:]))]
    assert np.allclose(model.centroids, cents, atol=1e-5)
    pred, score, _ = langid.predict(model, pa.array(texts, pa.large_string()))
    for k, v in enumerate(vec):
        near = [float(v @ x) for x in cents]
        assert pred[k] == "pq"[int(np.argmax(near))]
        assert score[k] == pytest.approx(1 / sum(np.exp((x - max(near)) / langid.TEMPERATURE) for x in near), abs=1e-3)


def test_rare_insults_are_learned_from_large_samples():
    """In 9 contexts among 1,000 toxic texts, as among 100."""
    word = pa.array(["zounderkite"], pa.large_string())
    for n in (100, 1000):
        toxic = [f"w{k} you are a moron and m{k} n{k}" + (f" p{k} zounderkite q{k}" if k < 9 else "") for k in range(n)]
        plain = [f"w{k} we are at home and m{k} n{k} p{k} q{k}" for k in range(5 * n // 2)]
        model, block = toxicity.fit_texts(pa.array(toxic + plain, pa.large_string()), [1] * n + [0] * len(plain)), toxicity.TextBlock(word)
        assert np.isin(block.span_hash(*block.words()[:2]), model.keys[0]).all()


def test_language_id(larger, odd, none):
    docs = larger["documents"]
    model = langid.fit(docs)
    out = langid.identify(docs, model).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    known = out[out.lang.notna()]
    assert (known.lang_pred == known.lang)[known.held_out].mean() > 0.97 and known.score.between(0, 1).all() and known.rejected.mean() < 0.01
    assert set(out.lang_pred) <= set(model.langs) | {"und"}
    r = {x.doc_id: x for x in langid.identify(odd, model).collect()}
    assert r[1].lang_pred == r[2].lang_pred == r[18].lang_pred == "und" and len(r) == len({x[0] for x in odd_rows()})
    assert langid.keep_known(odd, model).columns == odd.columns and langid.identify(none, model).count() == 0 and langid.fit(none) is None
    far = "".join(chr(0x3B1 + k % 24) + (" " if k % 6 == 5 else "") for k in range(900))
    assert langid.predict(model, pa.array([far], pa.large_string()))[2].tolist() == [True]


ITALIAN = "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, ché la diritta via era smarrita. Ahi quanto a dir qual era è cosa dura esta selva selvaggia e aspra e forte che nel pensier rinova la paura! Tant'è amara che poco è più morte; ma per trattar del ben ch'io vi trovai, dirò de l'altre cose ch'i' v'ho scorte. Io non so ben ridir com'i' v'intrai, tant'era pien di sonno a quel punto che la verace via abbandonai."
PORTUGUESE = "As armas e os barões assinalados que da ocidental praia lusitana, por mares nunca de antes navegados, passaram ainda além da Taprobana, em perigos e guerras esforçados mais do que prometia a força humana, e entre gente remota edificaram novo reino, que tanto sublimaram."


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_language_rejects_others_in_latin_script(spark, sf):
    """At few texts a language and at all 600."""
    docs = spark.read.parquet(f"{SMALL.replace('0.001', sf)}/documents.parquet")
    model = langid.fit(docs)
    rng = random.Random(1)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") if rng.random() < 0.85 else " " for _ in range(n))
    far = [ITALIAN, 2 * ITALIAN, PORTUGUESE, letters(400), letters(858), letters(2000), letters(20_000)]
    assert langid.predict(model, pa.array(far, pa.large_string()))[2].all()
    own = langid.identify(docs.where("lang is not null"), model)
    assert own.agg(F.avg(F.col("rejected").cast("int"))).first()[0] < 0.01


def test_language_limit_is_unmoved_by_junk(spark, larger):
    docs = larger["documents"].select("doc_id", "text", "lang")
    rng = random.Random(2)
    junk = spark.createDataFrame([(10**6 + k, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=2000)), "es") for k in range(8)], docs.schema)
    clean, mixed = (langid.fit(d) for d in (docs, docs.union(junk)))
    assert mixed.limit == pytest.approx(clean.limit, abs=0.05)


def recall(frame, got, every=20):
    """Share of the true 20 nearest that were found, by inner products of all pairs; every answer's ranks and scores are checked on the way."""
    x = np.stack(frame.embedding.to_numpy()).astype(float)
    ids = frame.vec_id.to_numpy()
    at = {v: k for k, v in enumerate(ids)}
    hits = total = 0
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:20]
        mine = got[got.query_id == ids[i]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, len(order) + 1)) and mine.score.is_monotonic_decreasing
        assert mine.score.to_numpy() == pytest.approx(x[[at[v] for v in mine.vec_id]] @ x[i], abs=1e-12)
        hits, total = hits + len(set(mine.vec_id) & set(ids[order])), total + len(order)
    return hits / total


def test_neighbours(small):
    e = small["embeddings"].toPandas()
    assert recall(e, vptree.nearest(small["embeddings"], shard_rows=128).toPandas()) >= 0.9
    assert recall(e, vptree.nearest(small["embeddings"], factor=1.0, shard_rows=64, block_rows=7).toPandas()) == 1.0


def test_neighbours_of_many_lengths(spark):
    """Inner products of vectors of unlike norms, with many copies of one."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 6)) * rng.lognormal(0, 1, (900, 1))
    x[300:600] = x[0]
    frame = pd.DataFrame({"vec_id": np.arange(900), "embedding": list(x)})
    got = vptree.nearest(spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), factor=1.0, shard_rows=100).toPandas()
    for i in range(0, 900, 20):
        s = vptree.exact_scores(x, np.repeat(x[i : i + 1], 900, 0))
        want = [j for j in np.lexsort((np.arange(900), -s)) if j != i][:20]
        assert got[got.query_id == i].sort_values("rank").vec_id.tolist() == want
    assert len(frame) == 900


def test_trees_prune():
    """Scanned share and recall on clustered vectors; factor one is exact and prunes too, and a larger factor scans less."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 32))
    x = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 32)) * 0.15
    top = np.sqrt((x * x).sum(1)).max()
    tree, q = vptree.Tree(vptree.lift(x, top)), x[::40]
    true = [set(np.argsort(-(x @ v), kind="stable")[:20]) for v in q]
    shares = []
    for factor in (1.0, vptree.FACTOR, 1.5):
        row, point, scanned = vptree.search(tree, vptree.lift_queries(q), 20, factor)
        found = [set(point[row == k]) for k in range(len(q))]
        shares.append(scanned / (len(q) * len(x)))
        hit = np.mean([len(f & t) / 20 for f, t in zip(found, true)])
        assert hit == 1.0 if factor == 1.0 else hit >= 0.9 or factor > vptree.FACTOR
    assert shares[2] < 0.2 < shares[1] < 0.35 < shares[0] < 0.5, shares


def test_neighbours_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, [1.0]), (None, [1.0, 1.0]), (40, None)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, `rank` string")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in vptree.nearest(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 2, 0.5), (0, 4, 20, 0.0), (20, 1, 2, 0.5), (20, 2, 0, 0.0), (20, 3, 1, 0.0), (20, 4, 2, 0.0)]
    assert vptree.nearest(df.where("false")).count() == 0


def test_pieces_round_trip(odd, none, small):
    enc = pieces.encode_documents(odd)
    text = {(r.doc_id, r.text) for r in pieces.decode_documents(enc).collect()}
    assert text == {(r[0], r[1] or "") for r in odd_rows()}
    d = pieces.digest(small["documents"]).toPandas()
    assert d.round_trip.all() and len(d) == small["documents"].count()
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=pieces.default_model())
    want = {r.doc_id: sp.encode(r.text or "") for r in small["documents"].collect()}
    assert {r.doc_id: (r.n_pieces, r.ids_crc32) for r in d.itertuples()} == {i: (len(x), zlib.crc32(np.array(x, np.int32).tobytes())) for i, x in want.items()}
    assert pieces.digest(none).count() == 0 and pieces.encode_documents(none).count() == 0


def test_line_dedup_is_native(odd):
    plan = linededup.digest(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
