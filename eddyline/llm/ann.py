"""Operator 3, approximate nearest neighbours by learned partitions.

1. A neighbour graph (``GRAPH_K`` nearest by cosine) is built over a bounded
   sample of ``SAMPLE`` vectors, chosen by a hash of the id.
2. The graph is cut into balanced parts: every cut splits a node set in two equal
   halves along a smoothed direction of the graph, then swaps pairs of nodes that
   have more neighbours on the other side.
3. A small classifier (one hidden layer) learns to tell a vector's part; its
   targets are the parts of the vector's graph neighbours.
4. Every row is indexed under its most probable part.  A query is routed to its
   several most probable parts.  How many is measured on a held-back share of the
   sample: the smallest number that finds ``RECALL`` of their true neighbours.
5. The routed parts are reranked exactly: cosine in double precision on the
   original vectors.

6. A query whose routed parts hold fewer than ``k`` other ids is sent to all parts,
   so it gets ``k`` neighbours wherever there are so many.

A part's rows are cut into blocks of about ``BLOCK`` and its queries into slices,
so a part of any size is spread over (block, slice) tasks; a task holds one
slice of queries and a chunk of rows, and passes on the best few of each query.

Vectors that are null, zero or hold null or non-finite components take no part,
nor do those whose length is not the most common one (the smallest of equally
common ones).  Ties go to the smaller id.  A query's own id is no candidate, nor
are repeated rows of that id; repeated rows of another id count once.  Rows of a
null id take no part.  An empty table gives no row.  Other columns, whatever their
names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.llm.common import materialize

SAMPLE = 8192        # vectors that the index is fitted on, about (at most twice)
PARTS = 64           # parts, fewer for a small sample
PART_MIN = 64        # sampled vectors of a part at least
GRAPH_K = 10
HIDDEN = 128
RECALL = 0.97        # aimed at on the held-back share of the sample
HELD_BACK = 10       # one sampled vector in so many is held back
BLOCK = 8192         # rows of a block
SLICE = 2048         # queries of a slice
CHUNK = 2048         # rows scored at once
NEAR = 1e-9          # scores this close to the k-th are compared exactly


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and very small components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine_many(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of ``q`` with each row; equal rows get equal results."""
    return (unit_rows(rows) * unit_rows(q[None, :])).sum(axis=1)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` nearest other rows of each row (of length 1)."""
    n, out = len(x), []
    f = x.astype(np.float32)
    for a in range(0, n, 512):
        s = f[a:a + 512] @ f.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -9
        out.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def _halve(nodes: np.ndarray, graph: np.ndarray, x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of equal size with few neighbours across."""
    at = np.full(len(graph), -1)
    at[nodes] = np.arange(len(nodes))
    near = at[graph[nodes]]
    inside = near >= 0
    near = np.where(inside, near, 0)
    degree = np.maximum(1, inside.sum(axis=1))
    c = x[nodes] - x[nodes].mean(axis=0)
    v = c @ rng.standard_normal(x.shape[1])
    for _ in range(4):          # the direction of largest spread
        v = c @ (c.T @ v)
        v /= np.linalg.norm(v) + 1e-12
    for _ in range(30):         # smoothed over the graph
        v = 0.5 * v + 0.5 * (v[near] * inside).sum(axis=1) / degree
        v -= v.mean()
        v /= np.linalg.norm(v) + 1e-12
    side = np.zeros(len(nodes), dtype=np.int64)
    side[np.argsort(v, kind="stable")[len(nodes) // 2:]] = 1
    for _ in range(10):         # swap pairs that gain
        other = ((side[near] != side[:, None]) & inside).sum(axis=1)
        back = np.bincount(near[inside], (side[near] != side[:, None])[inside], minlength=len(nodes))
        total = inside.sum(axis=1) + np.bincount(near[inside], minlength=len(nodes))
        gain = 2 * (other + back) - total
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        k = min(len(a), len(b))
        k = int((gain[a[:k]] + gain[b[:k]] > 2).sum())
        k -= k // 2             # half at a time, as gains change together
        if not k:
            break
        side[a[:k]], side[b[:k]] = 1, 0
    return nodes[side == 0], nodes[side == 1]


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """The part of each row; sizes differ by one at most per halving."""
    rng = np.random.default_rng(seed)
    sets = [np.arange(len(x))]
    while len(sets) < parts:
        sets = [h for s in sets for h in _halve(s, graph, x, rng)]
    out = np.zeros(len(x), dtype=np.int64)
    for i, s in enumerate(sets):
        out[s] = i
    return out


class Router:
    """A small classifier that gives the probability of each part."""

    def __init__(self, w1: np.ndarray, b1: np.ndarray, w2: np.ndarray, b2: np.ndarray) -> None:
        self.w1, self.b1, self.w2, self.b2 = w1, b1, w2, b2

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x.astype(np.float32) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    @classmethod
    def fit(cls, x: np.ndarray, target: np.ndarray, hidden: int = HIDDEN, rounds: int = 40, seed: int = 11) -> Router:
        rng = np.random.default_rng(seed)
        x, target = x.astype(np.float32), target.astype(np.float32)
        d, p = x.shape[1], target.shape[1]
        w = [rng.standard_normal((d, hidden)).astype(np.float32) * np.float32(np.sqrt(2)), np.zeros(hidden, np.float32),
             rng.standard_normal((hidden, p)).astype(np.float32) * np.float32(np.sqrt(1 / hidden)), np.zeros(p, np.float32)]
        m1, m2, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for r in range(rounds):
            rate = 0.01 * (1 - r / rounds) + 1e-4
            for s in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
                h = np.maximum(x[s] @ w[0] + w[1], 0)
                z = h @ w[2] + w[3]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                g = (z / z.sum(axis=1, keepdims=True) - target[s]) / len(s)
                gh = (g @ w[2].T) * (h > 0)
                grads = [x[s].T @ gh, gh.sum(axis=0), h.T @ g, g.sum(axis=0)]
                t += 1
                for i, q in enumerate(grads):
                    m1[i] = 0.9 * m1[i] + 0.1 * q
                    m2[i] = 0.999 * m2[i] + 0.001 * q * q
                    w[i] = w[i] - np.float32(rate) * (m1[i] / (1 - 0.9 ** t)) / (np.sqrt(m2[i] / (1 - 0.999 ** t)) + 1e-8)
        return cls(*w)


class PartitionIndex:
    def __init__(self, router: Router | None, parts: int, probes: int) -> None:
        self.router, self.parts, self.probes = router, parts, probes

    def route(self, x: np.ndarray, many: int) -> np.ndarray:
        """The ``many`` most probable parts of each vector, best first."""
        if self.router is None:
            return np.zeros((len(x), 1), dtype=np.int64)
        return np.argsort(-self.router.logits(unit_rows(x)), axis=1, kind="stable")[:, :many]


def fit_index(vectors: np.ndarray, k: int, parts: int = PARTS, recall: float = RECALL) -> PartitionIndex:
    """An index fitted on a sample of vectors."""
    n = len(vectors)
    while parts > 1 and n < parts * PART_MIN:
        parts //= 2
    if parts < 2:
        return PartitionIndex(None, 1, 1)
    x = unit_rows(np.asarray(vectors, dtype=np.float64))
    held = np.arange(n) % HELD_BACK == 0
    base, ask = x[~held], x[held]
    graph = neighbour_graph(base, GRAPH_K)
    part = balanced_parts(base, graph, parts)
    target = np.eye(parts)[part] * 0.5
    for j in range(GRAPH_K):
        target += 0.5 / GRAPH_K * np.eye(parts)[part[graph[:, j]]]
    index = PartitionIndex(Router.fit(base, target), parts, 1)
    # Where in a held-back query's order of parts its true neighbours lie.
    placed = index.route(base, 1)[:, 0]
    order = np.argsort(index.route(ask, parts), axis=1)
    k = min(k, len(base))
    nearest = np.argpartition(-(ask @ base.T), k - 1, axis=1)[:, :k]
    at = np.sort(np.take_along_axis(order, placed[nearest], axis=1), axis=None)
    index.probes = int(at[min(len(at) - 1, int(np.ceil(recall * len(at))) - 1)]) + 1
    return index


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vec: Column) -> Column:
    """Not null, not zero, all components finite."""
    fine = F.forall(vec, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return vec.isNotNull() & fine & F.exists(vec, lambda v: v != 0)


def _search(dim: int, k: int):
    names = ["query_id", "vec_id", "score"]

    def best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
        rough = unit_rows(q) @ unit_rows(c).T
        out_q, out_c, out_s = [], [], []
        for i in range(len(q)):
            s = rough[i]
            at = np.arange(len(s))
            many = k + 1
            while many + 1 < len(s):
                cut = np.partition(s, len(s) - many)[len(s) - many]
                # Enough once k other ids are at or above the cut itself; repeats take no place.
                if len(set(cid[s >= cut].tolist()) - {qid[i]}) >= k:
                    at = np.flatnonzero(s >= cut - NEAR)
                    break
                many *= 2
            at = at[cid[at] != qid[i]]
            if not len(at):
                continue
            exact = cosine_many(q[i], c[at])
            ids = cid[at]
            top, seen = [], set()
            for j in np.lexsort((ids, -exact)).tolist():
                if ids[j] not in seen:
                    top.append(j)
                    seen.add(ids[j])
                if len(top) == k:
                    break
            out_q += [qid[i]] * len(top)
            out_c += ids[top].tolist()
            out_s += exact[top].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_q, pa.int64()), pa.array(out_c, pa.int64()), pa.array(out_s, pa.float64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (group, is a candidate): a group's queries, then its rows."""
        group, qid, q, cid, c, held = None, [], [], [], [], 0
        for b in batches:
            g = b.column(0).to_numpy(zero_copy_only=False)
            role = b.column(1).to_numpy(zero_copy_only=False)
            ids = b.column(2).to_numpy(zero_copy_only=False)
            x = _matrix(b.column(3), dim)
            edge = np.flatnonzero(np.diff(g) | np.diff(role)) + 1
            for a, z in zip([0, *edge.tolist()], [*edge.tolist(), len(g)]):
                if a == z:
                    continue
                if g[a] != group:
                    if qid and cid:
                        yield from best(*map(np.concatenate, (qid, q, cid, c)))
                    group, qid, q, cid, c, held = g[a], [], [], [], [], 0
                if role[a] == 0:
                    qid.append(ids[a:z])
                    q.append(x[a:z])
                    continue
                for s in range(a, z, CHUNK):
                    t = min(z, s + CHUNK)
                    cid.append(ids[s:t])
                    c.append(x[s:t])
                    held += t - s
                    if held >= CHUNK:
                        if qid:
                            yield from best(*map(np.concatenate, (qid, q, cid, c)))
                        cid, c, held = [], [], 0
        if qid and cid:
            yield from best(*map(np.concatenate, (qid, q, cid, c)))
    return run


def nearest(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vec_col: str = "embedding", parts: int = PARTS, sample: int = SAMPLE,
            recall: float = RECALL) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row
    for which ``is_query`` holds, among all rows."""
    vec = F.col("vec")
    d = rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vec_col}`").alias("vec"),
                    F.coalesce(is_query, F.lit(False)).alias("ask")).where(F.col("id").isNotNull() & usable(vec))
    sizes = d.groupBy(F.size(vec).alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if sizes is None:
        return rows.sparkSession.createDataFrame([], empty)
    dim, n = sizes["dim"], sizes["n"]
    d = d.where(F.size(vec) == dim)
    draw = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30))
    picked = d.where(draw < int(min(1.0, sample / n) * (1 << 30))).select("vec").limit(2 * sample).toArrow()
    got = _matrix(picked.column("vec").combine_chunks(), dim) if picked.num_rows else np.zeros((0, dim))
    index = fit_index(got, k, parts, recall)
    probes = index.probes

    @F.arrow_udf(T.IntegerType())
    def home(col: pa.Array) -> pa.Array:
        return pa.array(index.route(_matrix(col, dim), 1)[:, 0], pa.int32())

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def routes(col: pa.Array) -> pa.Array:
        return pa.array(index.route(_matrix(col, dim), probes).tolist(), pa.list_(pa.int32()))

    placed = materialize(d.select("id", "vec", "ask", home("vec").alias("part")))
    rows_of = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = (placed.where("ask").select("id", "vec", routes("vec").alias("to"))
             .select("id", "vec", F.explode("to").alias("part")))
    found = materialize(_search_parts(placed, asked, rows_of, index.parts, dim, k))
    # Queries whose parts hold fewer than k other ids go to all parts as well.
    held = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    short = (placed.where("ask").join(held, F.col("id") == F.col("query_id"), "left")
             .where(F.coalesce("n", F.lit(0)) < k).select("id", "vec"))
    if probes < index.parts and not short.isEmpty():
        every = short.select("id", "vec", F.explode(F.sequence(F.lit(0), F.lit(index.parts - 1))).alias("part"))
        more = _search_parts(placed, every, rows_of, index.parts, dim, k)
        found = (found.unionByName(more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search_parts(placed: DataFrame, asked: DataFrame, rows_of: dict[int, int], parts: int, dim: int,
                  k: int) -> DataFrame:
    """``query_id, vec_id, score``: the ``k`` best of each (block, slice) task for the queries
    ``asked(id, vec, part)`` in the rows ``placed(id, vec, part)``."""
    # At most PARTS rows: queries sent to the parts.
    asks_of = {r["part"]: r["n"] for r in asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = [-(-rows_of.get(p, 0) // BLOCK) or 1 for p in range(parts)]
    slices = [-(-asks_of.get(p, 0) // SLICE) or 1 for p in range(parts)]
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), F.col("part") + 1)
    own = lambda tag, xs: F.pmod(F.xxhash64(F.lit(tag), "id"), pick(xs))
    every = lambda xs: F.explode(F.sequence(F.lit(0), pick(xs) - 1))
    number = lambda: F.xxhash64("part", F.col("block").cast("bigint"), F.col("slice").cast("bigint"))
    queries = (asked.withColumn("slice", own("slice", slices)).withColumn("block", every(blocks))
               .select(number().alias("g"), F.lit(0).alias("role"), "id", "vec"))
    candidates = (placed.where(pick([int(p in asks_of) for p in range(parts)]) == 1)
                  .withColumn("block", own("block", blocks)).withColumn("slice", every(slices))
                  .select(number().alias("g"), F.lit(1).alias("role"), "id", "vec"))
    return (queries.unionByName(candidates).repartition("g").sortWithinPartitions("g", "role")
            .mapInArrow(_search(dim, k), "query_id bigint, vec_id bigint, score double")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
