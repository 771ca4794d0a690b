"""Approximate nearest neighbours by largest inner product: vantage-point trees, one a shard, with triangle-inequality pruning relaxed by a
tunable factor.

Vectors get one more coordinate, sqrt(M*M - |x|*|x|) for the largest norm M, and queries get 0 there; both are scaled to unit length.
Among vectors so lifted the one at the least angle has the largest inner product, and angles obey the triangle inequality. A leaf knows, for
every vantage point of its tree, between which angles its points lie, so a query's own angles to the vantage points bound from below how near
the leaf can come. Leaves are taken in order of their bounds. One is skipped if bound * factor exceeds the angle of the query's
k-th best so far: factor 1 is exact search, a larger one skips more.

Distinct vectors are dealt to shards by a first tree, grown on a bounded sample of them, so that a shard holds near ones and can be
skipped as a whole by the same rule; every vector is indexed. A leaf of that tree that is larger than a shard is dealt to several by hash. Each shard's tree is built once and stored. A query searches its nearest
shard, then, knowing its k-th best, those other shards that the rule leaves. Vectors are moved once, trees go only where queries are.

Cases: null or zero vectors, and such as hold null or non-finite components or differ in dimension from most, take no part, as
queries or candidates; so do null ids. Ties go to smaller ids. Fewer candidates than k are all returned. Rows that repeat an
id are candidates each, but none of them for a query of that id; a query id on several rows is searched with the first of its vectors in
order. Of equal vectors only as many rows are kept as can be returned. An empty table gives an empty table; extra columns pass by."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import cut
from millrace.session import ship_package

K, EVERY = 20, 20
#: How much pruning is relaxed; README and the tests give recall and the share of points that is scanned.
FACTOR = 1.15
#: Distinct vectors of a shard and of a leaf, leaves of the first tree (beyond them a leaf is dealt to several shards), queries of a task, vectors of the first tree's sample.
SHARD_ROWS, LEAF, MOST_SHARDS, BLOCK_ROWS, SAMPLE = 8192, 64, 4096, 4096, 20_000
#: Vantage points tried at each split, and such of the first tree as bound whole shards.
TRIED, ROUTE_POINTS = 6, 64
#: Slack of angles, for arc cosines near 0 are inexact.
EPS = 1e-6


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def gaps(d: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(queries, boxes): the least angle that each box may be away, from the angles d (queries, vantage points) and the boxes' ranges."""
    out = np.zeros((len(d), len(lo)))
    for j in range(d.shape[1]):
        x = d[:, j : j + 1]
        np.maximum(out, np.maximum(lo[None, :, j] - x, x - hi[None, :, j]), out=out)
    return out


class Tree:
    """Vantage-point tree over unit vectors (n, d): split at the median angle from that of a few far points whose angles spread most."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.vantage = points, []
        leaves: list[np.ndarray] = []
        self.root = self._grow(np.arange(len(points)), leaf, leaves)
        self.leaves = leaves
        v = points[np.array(self.vantage, np.int64)]
        self.lo, self.hi = np.zeros((len(leaves), len(v))), np.zeros((len(leaves), len(v)))
        for k, at in enumerate(leaves):
            d = angles(points[at], v)
            self.lo[k], self.hi[k] = d.min(0, initial=np.pi), d.max(0, initial=0.0)

    def _grow(self, at: np.ndarray, leaf: int, leaves: list):
        if len(at) <= leaf:
            leaves.append(at)
            return len(leaves) - 1
        some = self.points[at[:: max(1, len(at) // 256)]]
        far = at[np.argsort(self.points[at] @ some.mean(0), kind="stable")[:: max(1, len(at) // TRIED)][:TRIED]]
        v = far[np.argmax(angles(self.points[far], some).var(axis=1))]
        d = angles(self.points[at], self.points[v : v + 1])[:, 0]
        order = np.argsort(d, kind="stable")
        half = len(at) // 2
        self.vantage.append(v)
        mine = len(self.vantage) - 1
        border = (d[order[half - 1]] + d[order[half]]) / 2
        return mine, border, self._grow(at[order[:half]], leaf, leaves), self._grow(at[order[half:]], leaf, leaves)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls into by the borders alone."""
        return fall(self.root, angles(x, self.points[np.array(self.vantage, np.int64)]) if self.vantage else np.zeros((len(x), 0)))


def fall(root, d: np.ndarray) -> np.ndarray:
    """The leaf of each row of angles to a tree's vantage points."""
    out = np.zeros(len(d), np.int64)

    def down(node, rows: np.ndarray) -> None:
        if isinstance(node, int):
            out[rows] = node
            return
        j, border, near, far = node
        inside = d[rows, j] <= border
        down(near, rows[inside])
        down(far, rows[~inside])

    down(root, np.arange(len(d)))
    return out


def search(tree: Tree, q: np.ndarray, k: int, factor: float, least: np.ndarray | None = None, names: np.ndarray | None = None, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(query number, point) pairs that hold the k best points of each unit query, as far as the factor lets them be found and they are no worse
    than ``least`` (cosines), ties included; and the number of points scanned. Points whose name is the query's own are passed over."""
    n = len(q)
    kth = np.full(n, -2.0) if least is None else least.copy()
    top = np.full((n, k), -2.0)
    bound = gaps(angles(q, tree.points[np.array(tree.vantage, np.int64)]), tree.lo, tree.hi) if tree.vantage else np.zeros((n, len(tree.leaves)))
    order = np.argsort(bound, axis=1, kind="stable")
    pairs, scanned, live = [], 0, np.arange(n)
    for r in range(len(tree.leaves)):
        leaf = order[live, r]
        reach = np.where(kth[live] > -2.0, np.arccos(np.clip(kth[live], -1.0, 1.0)), 7.0)
        near = bound[live, leaf] * factor <= reach + EPS
        live, leaf = live[near], leaf[near]  # later leaves of a query are no nearer
        if not len(live):
            break
        by = np.argsort(leaf, kind="stable")
        edge = np.flatnonzero(np.append(True, np.diff(leaf[by]) > 0))
        for rows in np.split(by, edge[1:]):
            who, at = live[rows], tree.leaves[leaf[rows[0]]]
            s = q[who] @ tree.points[at].T
            scanned += s.size
            if names is not None:
                s[names[at][None, :] == own[who][:, None]] = -3.0
            row, col = np.nonzero(s >= kth[who, None] - 1e-12)
            pairs.append((who[row], at[col], s[row, col]))
            both = np.concatenate((top[who], s), axis=1)
            top[who] = -np.partition(-both, k - 1, axis=1)[:, :k]
            kth[who] = np.maximum(kth[who], top[who].min(1))
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), scanned
    row, point, s = (np.concatenate(x) for x in zip(*pairs))
    good = s >= kth[row] - 1e-12
    return row[good], point[good], scanned


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed component by component, so that equal rows score equal."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def lift(x: np.ndarray, most: float) -> np.ndarray:
    """Candidates as unit vectors of one more dimension; ``most`` is the largest norm."""
    x = x / most
    return np.concatenate((x, np.sqrt(np.maximum(1.0 - (x * x).sum(1), 0.0))[:, None]), axis=1)


def lift_queries(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x / np.sqrt((x * x).sum(1, keepdims=True)), np.zeros((len(x), 1))), axis=1)


@dataclass
class Shard:
    """What is stored of a shard: its tree, the vectors as they came, and their ids, those of a vector one behind the other."""

    tree: Tree
    x: np.ndarray
    ids: np.ndarray
    begin: np.ndarray  # of each vector's ids, and the end of all

    def names(self) -> np.ndarray:
        """The number, in ascending ids, of the only id that a vector has; -1 if it has several, so that one is left for any query."""
        known = np.unique(self.ids)
        place = np.searchsorted(known, self.ids)
        lo, hi = np.minimum.reduceat(place, self.begin[:-1]), np.maximum.reduceat(place, self.begin[:-1])
        return np.where(lo == hi, lo, -1)


@dataclass
class Routes:
    """The first tree, without its sample: which shard a vector belongs to. At most MOST_SHARDS vantage points."""

    root: object
    all_vantage: np.ndarray
    most: float

    @property
    def vantage(self) -> np.ndarray:
        return self.all_vantage[:ROUTE_POINTS]

    def shard_of(self, x: np.ndarray) -> np.ndarray:
        return fall(self.root, angles(x, self.all_vantage))


def grow_routes(sample: np.ndarray, most: float, shards: int) -> Routes:
    tree = Tree(lift(sample, most), max(1, -(-len(sample) // shards)))
    return Routes(tree.root, tree.points[np.array(tree.vantage, np.int64)], most)


def search_shard(shard: Shard, qids: np.ndarray, q: np.ndarray, k: int, factor: float, least: np.ndarray) -> pd.DataFrame:
    """query_id, vec_id, score of the shard's k best candidates of each query, not counting those of the query's own id."""
    norm = np.sqrt((q * q).sum(1))
    known = np.unique(shard.ids)
    own = np.searchsorted(known, qids)
    own = np.where(known[np.minimum(own, len(known) - 1)] == qids, own, -2)
    row, point, _ = search(shard.tree, lift_queries(q), k, factor, least, shard.names(), own)
    take = np.diff(shard.begin)[point]
    at = np.arange(take.sum()) + np.repeat(shard.begin[:-1][point] - (np.cumsum(take) - take), take)
    row, point, found = np.repeat(row, take), np.repeat(point, take), shard.ids[at]
    other = found != qids[row]
    row, point, found = row[other], point[other], found[other]
    score = exact_scores(shard.x[point], q[row])
    order = np.lexsort((found, -score, row))
    row, found, score = row[order], found[order], score[order]
    use = np.arange(len(row)) - np.searchsorted(row, np.arange(len(q)))[row] < k
    return pd.DataFrame({"query_id": qids[row[use]], "vec_id": found[use], "score": score[use], "norm": norm[row[use]]})


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the rows that take part."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("x")).where(F.col("vec_id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda v: v != 0))


def distinct_points(x: DataFrame, k: int) -> DataFrame:
    """x and ids: every distinct vector with its least ids, each at most k times and 2k in all, so that k are left whatever one id a query has.
    Both cuts are made before rows are shuffled together, so a hot vector costs 2k rows a task."""
    order = lambda *by: F.row_number().over(Window.partitionBy("x", *by).orderBy("vec_id"))
    few = x.withColumn("r", order("vec_id")).where(F.col("r") <= k).withColumn("r", order()).where(F.col("r") <= 2 * k)
    return few.groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of every row whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    ship_package(spark)
    x = usable(vectors)
    dims = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = x.where(F.size("x") == dims["d"])
    points = cut(distinct_points(x, k))
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    n, top = points.agg(F.count("*"), F.max(square)).first()
    shards = max(1, min(MOST_SHARDS, -(-n // shard_rows)))
    routes = _routes(points, n, float(np.sqrt(top)) * (1.0 + 1e-12), shards)
    trees = cut(_trees(points, routes, shard_rows))
    each = lambda f, c: F.array(*[f(F.col(c)[j]) for j in range(len(routes.vantage))]).alias(c)
    boxes = trees.groupBy("shard").agg(each(F.min, "lo"), each(F.max, "hi")).collect()  # MOST_SHARDS * ROUTE_POINTS numbers at most
    bounds = {r["shard"]: (r["lo"], r["hi"]) for r in boxes}
    queries = x.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x"))
    first = cut(_search(trees, _home(queries, routes, sorted(bounds)), k, factor, block_rows))
    kth = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = first
    if len(bounds) > 1:
        worst = first.withColumn("r", F.row_number().over(kth)).where(F.col("r") == k).select(F.col("query_id").alias("vec_id"), (F.col("score") / F.col("norm") / routes.most).alias("least"))
        more = _others(queries.join(worst, "vec_id", "left"), routes, bounds, factor)
        found = first.union(_search(trees, more, k, factor, block_rows))
    return found.withColumn("rank", F.row_number().over(kth)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _routes(points: DataFrame, n: int, most: float, shards: int) -> Routes:
    """The first tree, of a sample of at most SAMPLE distinct vectors, those of the least hashes."""
    few = points.select("x", F.xxhash64("x").alias("h"))
    if n > SAMPLE:
        few = few.where(F.col("h") / F.lit(2.0**64) + 0.5 <= 1.2 * SAMPLE / n)
    rows = few.orderBy("h", "x").limit(SAMPLE if shards > 1 else 1).collect()
    return grow_routes(np.array([r["x"] for r in rows]), most, shards)


def _trees(points: DataFrame, routes: Routes, shard_rows: int) -> DataFrame:
    """shard, sub (of a leaf dealt to several), tree (its pickled Shard), lo and hi (its angles from the first tree's vantage points)."""

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            at = routes.shard_of(lift(np.stack(f["x"].to_numpy()), routes.most)) if len(f) else np.zeros(0, np.int64)
            yield f.assign(shard=at.astype(np.int32))

    def build(f: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(f["x"].to_numpy())
        long = lift(x, routes.most)
        d = angles(long, routes.vantage) if len(routes.vantage) else np.zeros((len(x), 0))
        begin = np.concatenate(([0], np.cumsum([len(i) for i in f["ids"]])))
        made = Shard(Tree(long), x, np.concatenate(f["ids"].to_numpy()).astype(np.int64), begin)
        return pd.DataFrame({"shard": f["shard"].iloc[:1], "sub": f["sub"].iloc[:1], "tree": [pickle.dumps(made)], "lo": [d.min(0)], "hi": [d.max(0)]})

    dealt = points.mapInPandas(route, "x array<double>, ids array<long>, shard int")
    # a leaf holds about shard_rows unless there are more leaves than the first tree may have
    sizes = dealt.groupBy("shard").agg(F.ceil(F.count("*") / (4 * shard_rows)).cast("int").alias("subs"))
    dealt = dealt.join(F.broadcast(sizes), "shard").withColumn("sub", F.pmod(F.xxhash64("x"), F.col("subs")).cast("int")).drop("subs")  # MOST_SHARDS rows at most
    return dealt.groupBy("shard", "sub").applyInPandas(build, "shard int, sub int, tree binary, lo array<double>, hi array<double>")


def _home(queries: DataFrame, routes: Routes, there: list[int]) -> DataFrame:
    """Queries with the shard that they fall into, or the next that holds any vector."""
    have = np.array(there)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            at = routes.shard_of(lift_queries(np.stack(f["x"].to_numpy()))) if len(f) else np.zeros(0, np.int64)
            yield f.assign(shard=have[np.minimum(np.searchsorted(have, at), len(have) - 1)].astype(np.int32), least=-2.0)

    return queries.mapInPandas(run, "vec_id long, x array<double>, shard int, least double")


def _others(queries: DataFrame, routes: Routes, bounds: dict, factor: float) -> DataFrame:
    """Queries with each shard but their own that can't be skipped."""
    have = np.array(sorted(bounds))
    lo, hi = (np.array([bounds[s][k] for s in have.tolist()]).reshape(len(have), -1) for k in (0, 1))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for begin in range(0, len(whole), 512):
                f = whole.iloc[begin : begin + 512]
                q = lift_queries(np.stack(f["x"].to_numpy()))
                at = routes.shard_of(q)
                home = have[np.minimum(np.searchsorted(have, at), len(have) - 1)]
                least = f["least"].fillna(-2.0).to_numpy()
                reach = np.where(least > -2.0, np.arccos(np.clip(least, -1.0, 1.0)), 7.0)
                near = (gaps(angles(q, routes.vantage), lo, hi) * factor <= reach[:, None] + EPS) & (have[None, :] != home[:, None])
                row, col = np.nonzero(near)
                yield pd.DataFrame({"vec_id": f["vec_id"].to_numpy()[row], "x": f["x"].to_numpy()[row], "shard": have[col].astype(np.int32), "least": least[row]})

    return queries.select("vec_id", "x", "least").mapInPandas(run, "vec_id long, x array<double>, shard int, least double")


def _search(trees: DataFrame, asked: DataFrame, k: int, factor: float, block_rows: int) -> DataFrame:
    """Every (query, shard) of ``asked`` against the shard's stored tree, by blocks of bounded size; a shard's tree goes to its blocks only."""
    asked = cut(asked)
    blocks = F.ceil(F.count("*") / block_rows).cast("int")
    parts = asked.groupBy("shard").agg(blocks.alias("parts"))
    sent = trees.select("shard", "sub", "tree").join(parts, "shard").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asked = asked.join(parts, "shard").join(trees.select("shard", (F.col("sub") + 0).alias("sub")), "shard").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0), "norm": np.zeros(0)})
        right = right.sort_values("vec_id")
        return search_shard(pickle.loads(left["tree"].iloc[0]), right["vec_id"].to_numpy(), np.stack(right["x"].to_numpy()), k, factor, right["least"].to_numpy())

    schema = "query_id long, vec_id long, score double, norm double"
    by = ["shard", "sub", "block"]
    return sent.select(*by, "tree").groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(one, schema)
