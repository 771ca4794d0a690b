"""One query for each operator, applied to its whole table, and the SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import bytebpe, langid, linededup, neardup, packing, phrases, pieces, qualitycrf, qualityrules, tokencounts, toxicity, veccodes, vptree
from millrace.llm.runtime import table


def op1_line_run_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.digest(table(spark, sf_dir, "documents"))


def op2_token_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.counted(table(spark, sf_dir, "documents"))


def op3_divergence_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityrules.judge(table(spark, sf_dir, "documents"))


def op4_variable_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_line_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return qualitycrf.score_documents(docs, qualitycrf.fit(docs, table(spark, sf_dir, "labels")))


def op6_centroid_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op7_vantage_point_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"))


def op8_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(table(spark, sf_dir, "documents"), size=4, percent=80)


def op10_toxic_span_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_apriori_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top(table(spark, sf_dir, "documents"))


def op12_interval_screened_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return veccodes.digest(table(spark, sf_dir, "embeddings"))


def op13_two_tier_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digest(table(spark, sf_dir, "documents"))


#: Exact Jaccard links over inverted shingles, then the least reachable id.
OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN coalesce(len(ws), 0) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.k, y.k HAVING 100 * count(*) >= 80 * (x.k + y.k - count(*))),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

#: Shortest runs of at least 50 characters from each line on and up to each line; one is a later copy if an equal stands earlier.
OP1_SQL = r"""
WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS p, ls FROM t),
o AS (SELECT doc_id, p, len(ls[p]) + 1 AS w FROM l),
c AS (SELECT doc_id, p, sum(w) OVER (PARTITION BY doc_id ORDER BY p) AS e, w FROM o),
s AS (
  SELECT a.doc_id, a.p AS lo, min(b.p) AS hi FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.p >= a.p AND b.p < a.p + 50 AND b.e - (a.e - a.w) >= 50 GROUP BY 1, 2
  UNION
  SELECT a.doc_id, max(b.p), a.p FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.p <= a.p AND b.p > a.p - 50 AND a.e - (b.e - b.w) >= 50 GROUP BY 1, 3),
k AS (SELECT s.doc_id, lo, hi, array_to_string(ls[lo:hi], chr(10)) AS body FROM s JOIN t ON t.doc_id = s.doc_id),
m AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, lo) AS r FROM k),
g AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS p FROM m WHERE r > 1),
x AS (SELECT l.doc_id, l.p, l.ls[l.p] AS line, g.p IS NOT NULL AS gone FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.p = l.p),
y AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM x),
z AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted, count(*) FILTER (begins) AS n_runs, coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '') AS rest FROM y GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, md5(rest) AS text_md5
FROM documents d LEFT JOIN z ON z.doc_id = d.doc_id
"""

#: All phrases of up to five words counted, every cut scored, and whatever a longer phrase explains taken out.
OP11_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM t),
s AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p CROSS JOIN (SELECT unnest(range(1, 6)) AS k) WHERE len(ws) >= k),
g AS (SELECT lang, CAST(k AS BIGINT) AS k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM s GROUP BY 1, 2, 3 HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY 1),
c AS (SELECT * FROM g WHERE k >= 2 AND NOT EXISTS (
  SELECT 1 FROM g b WHERE b.lang = g.lang AND b.k > g.k AND 100 * b.f >= 100 * g.f AND contains(' ' || b.phrase || ' ', ' ' || g.phrase || ' '))),
u AS (SELECT *, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS j FROM c),
x AS (
  SELECT u.lang, u.phrase, u.f AS a, j, l.f AS l, r.f AS r, n.n, CAST((CAST(1000 AS HUGEINT) * u.f * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM u JOIN n ON n.lang = u.lang JOIN g l ON l.lang = u.lang AND l.phrase = array_to_string(ws[1:j], ' ') JOIN g r ON r.lang = u.lang AND r.phrase = array_to_string(ws[j + 1:], ' ')),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS w FROM x),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM y WHERE w = 1)
SELECT * FROM z WHERE rank <= 2000
"""


def _op12_sql(parts: int = veccodes.PARTS, rounds: int = veccodes.ROUNDS) -> str:
    """Plain integer arithmetic over (row, part, place) triples, round after round. The row number tells repeated rows apart."""
    out = [
        f"""WITH e AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, label, embedding AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v) OR abs(v) >= 8796093022208)) = 0),
d AS (SELECT len(x) AS d FROM e GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
k AS MATERIALIZED (SELECT e.*, d // {parts} AS w FROM e JOIN d ON len(x) = d),
v AS MATERIALIZED (SELECT i, (j - 1) // w AS p, (j - 1) % w AS q, CAST(floor(CAST(x[j] AS DOUBLE) * 1024) AS BIGINT) AS v FROM (SELECT i, x, w, unnest(range(1, len(x) + 1)) AS j FROM k)),
s AS (SELECT i, row_number() OVER (ORDER BY vec_id) - 1 AS c FROM (SELECT vec_id, arg_min(i, x) AS i FROM k WHERE vec_id IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 256)),
b0 AS MATERIALIZED (SELECT c, p, q, v FROM s JOIN v USING (i))"""
    ]
    for r in range(rounds + 1):
        out.append(f"a{r} AS MATERIALIZED (SELECT i, p, min(t.d) AS d, arg_min(c, (t.d, c)) AS c FROM (SELECT i, p, c, sum((v.v - b.v) * (v.v - b.v)) AS d FROM v JOIN b{r} b USING (p, q) GROUP BY 1, 2, 3) t GROUP BY 1, 2)")
        if r < rounds:
            out.append(f"m{r} AS (SELECT c, p, q, CAST((sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v FROM a{r} JOIN v USING (i, p) GROUP BY 1, 2, 3)")
            out.append(f"b{r + 1} AS MATERIALIZED (SELECT c, p, q, coalesce(m{r}.v, b{r}.v) AS v FROM b{r} LEFT JOIN m{r} USING (c, p, q))")
    last = f"a{rounds}"
    out.append(f"h AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, c, q)) AS h FROM b{rounds})")
    out.append(f"f AS (SELECT vec_id, label, code, error FROM k JOIN (SELECT i, string_agg(printf('%02x', c), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM {last} GROUP BY 1) USING (i))")
    return ",\n".join(out) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM f CROSS JOIN h"


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_run_dedup,
        op2_token_length_histogram,
        op3_divergence_quality_rules,
        op4_variable_best_fit_packing,
        op5_line_crf_quality,
        op6_centroid_language_id,
        op7_vantage_point_neighbours,
        op8_sentencepiece_viterbi,
        op9_minhash_near_dedup,
        op10_toxic_span_crf,
        op11_apriori_collocations,
        op12_interval_screened_codes,
        op13_two_tier_byte_bpe,
    )
}
SQL = {"op1_line_run_dedup": OP1_SQL, "op9_minhash_near_dedup": OP9_SQL, "op11_apriori_collocations": OP11_SQL, "op12_interval_screened_codes": _op12_sql()}
