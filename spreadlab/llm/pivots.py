"""Exact top-k inner products with a pivot-distance index.

Components are turned into floor(256 x).  With M the largest squared norm, one
more component sqrt(M - |v|^2) puts all vectors on a sphere, where the largest
inner product with a query is the smallest distance.  Pivots are picked from a
bounded sample (``SAMPLE`` vectors, farthest first); every vector is keyed by its
nearest pivot and its distance to it, cut into annuli of fixed relative width
(at most ``PIVOTS * ANNULI`` of them, whatever the number of vectors); an annulus
with many vectors is split into blocks of about ``BLOCK`` by a hash.

A query first expands the annuli with the smallest triangle-inequality bounds
until they hold ``SEED`` vectors; its k-th best score there is a floor.  Then it
visits every other annulus whose bound allows that score (ties included) and
stops there: no skipped vector can enter the result.  Queries meet blocks in
groups of at most ``QUERIES`` by a join on the block; scores are exact integers.

Cases: vectors null, or with null or non-finite components, and rows with a null
id take no part; vectors of different lengths are not compared; equal rows count
once; all vectors with the query's own id are left out; ties go to the smaller
id; a query with fewer candidates returns all of them; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

PIVOTS = 48
ANNULI = 24
SAMPLE = 4096
BLOCK = 4096
QUERIES = 4096
SEED = 512
LIMIT = 2.0 ** 53


def quantised(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, dim, v): floor(256 x) as packed doubles; unusable rows dropped, equal rows once."""

    def run(batches):
        for b in batches:
            ids, out, dims = [], [], []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or v is None or any(x is None for x in v):
                    continue
                a = np.array(v, dtype=np.float64)
                if not np.isfinite(a).all():
                    continue
                ids.append(i)
                dims.append(len(a))
                out.append(np.floor(256.0 * a).tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                                  names=["vec_id", "dim", "v"])

    src = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).alias("v"))
    return src.mapInArrow(run, "vec_id bigint, dim int, v binary").distinct()


def _stack(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles while exact, in integers of any size beyond."""
    if not q.shape[1]:
        return np.zeros((len(q), len(v)))
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < LIMIT:
        return q @ v.T
    big = [[int(x) for x in row] for row in v.tolist()]
    return np.array([[sum(int(a) * b for a, b in zip(row, other)) for other in big] for row in q.tolist()], dtype=object)


def _lifted(v: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(top - (v * v).sum(axis=1), 0.0))
    return np.concatenate([v, rest[:, None]], axis=1)


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (x @ p.T)
    return np.sqrt(np.maximum(sq, 0.0))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first points of the sample."""
    if not len(sample):
        return sample
    picked = [0]
    d = _distances(sample, sample[:1])[:, 0]
    while len(picked) < min(count, len(sample)) and d.max() > 0:
        picked.append(int(d.argmax()))
        d = np.minimum(d, _distances(sample, sample[picked[-1:]])[:, 0])
    return sample[picked]


class Plan:
    """Index of one vector length: pivots, annuli and their sizes (all of bounded size)."""

    def __init__(self, dim: int, top: float, pivots: np.ndarray):
        self.dim, self.top, self.pivots = dim, top, pivots
        self.width = 2.0 * np.sqrt(max(top, 1.0)) / ANNULI          # no distance exceeds the sphere's diameter
        self.rings: dict = {}

    def keys(self, v: np.ndarray):
        """(pivot, annulus, distance) of vectors."""
        d = _distances(_lifted(v, self.top), self.pivots)
        near = d.argmin(axis=1)
        dist = d[np.arange(len(d)), near]
        return near, np.minimum((dist / self.width).astype(int), ANNULI - 1), dist

    def set_rings(self, rows):
        rows = sorted(rows, key=lambda r: (r["pivot"], r["ring"]))
        self.pivot = np.array([r["pivot"] for r in rows])
        self.ring = np.array([r["ring"] for r in rows])
        self.lo = np.array([r["lo"] for r in rows])
        self.hi = np.array([r["hi"] for r in rows])
        self.n = np.array([r["n"] for r in rows])

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(queries, annuli): no vector there scores more."""
        flat = np.concatenate([q, np.zeros((len(q), 1))], axis=1)    # a query's own last component is 0
        d = _distances(flat, self.pivots)[:, self.pivot]
        gap = np.maximum(np.maximum(self.lo - d, d - self.hi), 0.0)
        size = (q * q).sum(axis=1)[:, None] + self.top
        gap = np.maximum(gap - 1e-6 * np.sqrt(size + 1), 0.0)        # rounding of the distances
        return (size - gap * gap) / 2 + 1e-6 * (size + 1)


def build(base: DataFrame) -> tuple[dict, DataFrame]:
    """Plans by length, and the keyed vectors (dim, pivot, ring, block, vec_id, v)."""
    spark = base.sparkSession

    def norms(batches):
        for b in batches:
            n = [float((np.frombuffer(v, np.float64) ** 2).sum()) for v in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(n, pa.float64())], names=["dim", "norm"])

    tops = base.select("dim", "v").mapInArrow(norms, "dim int, norm double").groupBy("dim").agg(F.max("norm").alias("top"))
    plans = {}
    for r in tops.collect():                                        # one row per vector length
        picked = (base.where(F.col("dim") == r["dim"]).orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE)
                  .select("v").toArrow().column("v"))
        sample = _lifted(_stack(picked, r["dim"]) if r["dim"] else np.zeros((len(picked), 0)), r["top"])
        plans[r["dim"]] = Plan(r["dim"], r["top"], choose_pivots(sample, PIVOTS))
    shared = spark.sparkContext.broadcast(plans)

    def key(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims):
                sub = b.filter(pa.array(dims == dim))
                v = _stack(sub.column(2), dim) if dim else np.zeros((sub.num_rows, 0))
                p, ring, dist = shared.value[int(dim)].keys(v)
                yield pa.record_batch([sub.column(0), sub.column(1), sub.column(2), pa.array(p, pa.int32()),
                                       pa.array(ring, pa.int32()), pa.array(dist, pa.float64())],
                                      names=["vec_id", "dim", "v", "pivot", "ring", "dist"])

    keyed = saved(base.select("vec_id", "dim", "v").mapInArrow(
        key, "vec_id bigint, dim int, v binary, pivot int, ring int, dist double"))
    directory = keyed.groupBy("dim", "pivot", "ring").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"),
                                                          F.count("*").alias("n"))
    rows = directory.collect()                                      # at most PIVOTS * ANNULI rows a length
    for dim, plan in plans.items():
        plan.set_rings([r for r in rows if r["dim"] == dim])
    size = directory.select("dim", "pivot", "ring", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    blocks = (keyed.join(F.broadcast(size), ["dim", "pivot", "ring"])     # as many rows as the directory
              .withColumn("block", F.expr("CAST(pmod(xxhash64(vec_id, 5), blocks) AS INT)"))
              .select("dim", "pivot", "ring", "block", "vec_id", "v"))
    return plans, blocks


_VISIT = "query_id bigint, dim int, q binary, floor double, pivot int, ring int, block int"


def _visits(queries: DataFrame, plans: dict, first: bool) -> DataFrame:
    """(query, block) pairs of the first expansion, or of all annuli that the floor allows."""
    shared = queries.sparkSession.sparkContext.broadcast(plans)

    def run(batches):
        for b in batches:
            dims = b.column(1).to_numpy()
            for dim in np.unique(dims):
                sub = b.filter(pa.array(dims == dim))
                plan = shared.value[int(dim)]
                q = _stack(sub.column(2), dim) if dim else np.zeros((sub.num_rows, 0))
                floor = sub.column(3).to_numpy(zero_copy_only=False)
                for lo in range(0, len(q), 1024):
                    up = plan.bounds(q[lo: lo + 1024])
                    if first:
                        order = np.argsort(-up, axis=1, kind="stable")
                        before = np.cumsum(plan.n[order], axis=1) - plan.n[order]
                        take = np.zeros(up.shape, bool)
                        np.put_along_axis(take, order, before < SEED, axis=1)
                    else:
                        take = up >= floor[lo: lo + 1024, None]
                    who, ring = np.nonzero(take)
                    blocks = -(-plan.n[ring] // BLOCK)
                    who, ring = np.repeat(who, blocks), np.repeat(ring, blocks)
                    block = np.arange(len(who)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    rows = pa.array(who + lo)
                    yield pa.record_batch(
                        [sub.column(0).take(rows), sub.column(1).take(rows), sub.column(2).take(rows),
                         sub.column(3).take(rows), pa.array(plan.pivot[ring], pa.int32()),
                         pa.array(plan.ring[ring], pa.int32()), pa.array(block, pa.int32())],
                        names=["query_id", "dim", "q", "floor", "pivot", "ring", "block"])

    return queries.select("query_id", "dim", "q", "floor").mapInArrow(run, _VISIT)


def _visit(visits: DataFrame, blocks: DataFrame, k: int, parts: int) -> DataFrame:
    """Best k candidates of every (query, block) pair at or above the query's floor."""
    keys = ["dim", "pivot", "ring", "block", "part"]
    left = visits.withColumn("part", F.expr(f"CAST(pmod(xxhash64(query_id, 9), {parts}) AS INT)"))
    right = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            ids = right.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            v = (_stack(right.column("v"), dim) if dim else np.zeros((len(ids), 0)))[order]
            q = _stack(left.column("q"), dim) if dim else np.zeros((left.num_rows, 0))
            own, floor = left.column("query_id").to_numpy(), left.column("floor").to_numpy()
            for lo in range(0, len(q), 512):
                s = _scores(q[lo: lo + 512], v)
                for i in range(len(s)):
                    ok = np.flatnonzero((s[i] >= floor[lo + i]) & (ids != own[lo + i]))
                    if len(ok) > 8 * k and s.dtype != object:
                        cut = np.partition(s[i][ok], len(ok) - k)[len(ok) - k]
                        ok = ok[s[i][ok] >= cut]
                    best = sorted(ok.tolist(), key=lambda j: (-s[i][j], ids[j]))[:k]
                    out["query_id"] += [int(own[lo + i])] * len(best)
                    out["vec_id"] += ids[best].tolist()
                    out["score"] += [int(s[i][j]) for j in best]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    return (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInArrow(meet, "query_id bigint, vec_id bigint, score bigint"))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of every query (ids divisible by ``every``)."""
    from pyspark.sql import Window
    base = saved(quantised(vectors, id_col, vec_col))
    plans, blocks = build(base)
    asked = base.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "dim", F.col("v").alias("q"))
    parts = max(1, -(-asked.count() // QUERIES))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found):
        return (found.distinct().withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k))

    start = asked.withColumn("floor", F.lit(float("-inf")))
    seen = saved(best(_visit(_visits(start, plans, True), blocks, k, parts)))
    floor = (seen.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n"))
             .select("query_id", F.when(F.col("n") >= k, F.col("low").cast("double")).alias("f")))
    again = (asked.join(floor, "query_id", "left")
             .withColumn("floor", F.coalesce("f", F.lit(float("-inf")))).select("query_id", "dim", "q", "floor"))
    return (best(_visit(_visits(again, plans, False), blocks, k, parts))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
