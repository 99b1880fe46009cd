"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

A fast Hadamard pseudo-rotation spreads each unit vector over all axes; its hash is the nearest signed
axis. Hashes of several rotations join up until a bucket holds a bounded number of vectors on average,
whatever the input's size; the last one uses fewer axes to meet that number. Queries probe the likeliest
buckets of each table: as many as it takes to find a bounded sample of queries' true neighbours, which
one pass over all vectors gives. Equal vectors are indexed once with the few ids that a result can show.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import BROADCAST_ROWS, mixed, written

#: Tables, least probes of a query in each, and distinct vectors that a bucket holds on average.
TABLES, PROBES, BUCKET = 6, 24, 320
#: Queries of each dimension whose true neighbours set the probes, and the share of them to be found.
SAMPLE, RECALL = 100, 0.95
#: Index vectors that one task compares with a bucket's queries; larger buckets are split.
BLOCK = 4_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, orthonormal."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / math.sqrt(d)


class CrossPolytope:
    """The hash functions for vectors of one dimension and an index of a given size."""

    def __init__(self, dimension: int, distinct: int) -> None:
        self.d = 1 << max(1, (dimension - 1).bit_length())
        bits = max(1, math.ceil(math.log2(max(2, distinct / BUCKET))))
        full = self.d.bit_length()  # a signed axis of d names 2 d things
        self.axes = [self.d] * (bits // full) + ([1 << (bits % full - 1)] if bits % full else [])

    def _rotated(self, x: np.ndarray, table: int, part: int) -> np.ndarray:
        for k in range(3):
            seed = np.uint64(((table * 64 + part) * 3 + k) << 20)
            sign = 1.0 - 2.0 * (mixed(np.arange(self.d, dtype=np.uint64) + seed) & np.uint64(1)).astype(np.float64)
            x = hadamard(x * sign)
        return x

    def values(self, vectors: np.ndarray, table: int) -> list[np.ndarray]:
        """For each part the coordinates along +axis, then along -axis."""
        x = np.zeros((len(vectors), self.d))
        x[:, : vectors.shape[1]] = vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))
        out = []
        for part, axes in enumerate(self.axes):
            y = self._rotated(x, table, part)[:, :axes]
            out.append(np.concatenate([y, -y], axis=1))
        return out

    def buckets(self, vectors: np.ndarray, table: int) -> np.ndarray:
        key = np.zeros(len(vectors), np.int64)
        for v in self.values(vectors, table):
            key = key * v.shape[1] + v.argmax(axis=1)
        return key

    @property
    def n_buckets(self) -> int:
        return math.prod(2 * a for a in self.axes)

    def probes(self, vectors: np.ndarray, table: int, n: int) -> np.ndarray:
        """The n buckets whose axes together lie nearest, for each vector (-1 where there are fewer)."""
        step = max(1, (1 << 22) // (n * 2 * self.d))
        return np.concatenate([self._probes(vectors[i : i + step], table, n) for i in range(0, len(vectors), step)])

    def meets(self, vectors: np.ndarray, table: int, n: int, homes: np.ndarray) -> np.ndarray:
        """Whether a vector's bucket of ``homes`` is among its n probes. The probes aren't kept: a few vectors' at a time."""
        step = max(1, (1 << 19) // (n * 2 * self.d))
        slices = [slice(i, i + step) for i in range(0, len(vectors), step)]
        return np.concatenate([(self._probes(vectors[s], table, n) == homes[s, None]).any(axis=1) for s in slices] or [np.zeros(0, bool)])

    def _probes(self, vectors: np.ndarray, table: int, n: int) -> np.ndarray:
        rows = np.arange(len(vectors))[:, None]
        keys, cost = np.zeros((len(vectors), 1), np.int64), np.zeros((len(vectors), 1))
        for v in self.values(vectors, table):
            width = v.shape[1]
            gap = (v.max(axis=1, keepdims=True) - v) ** 2
            both = (cost[:, :, None] + gap[:, None, :]).reshape(len(v), -1)
            name = (keys[:, :, None] * width + np.arange(width)).reshape(len(v), -1)
            best = np.argsort(both, axis=1, kind="stable")[:, :n]
            keys, cost = name[rows, best], both[rows, best]
        return np.pad(keys, ((0, 0), (0, n - keys.shape[1])), constant_values=-1)


def usable(vectors: DataFrame) -> DataFrame:
    """id, v of the vectors that take part: not null, not zero, all components there and finite."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(finite & F.exists("v", lambda x: x != 0))


def true_neighbours(index: DataFrame, asked: list, k: int) -> list:
    """query_id, query, v of the k nearest of all, for a bounded list of queries (id, v, dim)."""
    kind = index.schema["v"].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                members, v = part["ids"].to_numpy(), part["v"].to_numpy()
                out = []
                for r in asked:
                    if r.dim == dim:
                        d = np.sqrt(((x - np.asarray(r.v, np.float64)) ** 2).sum(axis=1))
                        edge = np.partition(d, k)[k] if len(d) > k + 1 else np.inf
                        out += sorted(((r.id, d[j], int(i), j) for j in np.flatnonzero(d <= edge).tolist() for i in members[j] if i != r.id), key=lambda y: y[1:3])[:k]
                yield pd.DataFrame({"query_id": [o[0] for o in out], "score": [o[1] for o in out], "vec_id": [o[2] for o in out], "v": [v[o[3]] for o in out]}).astype({"query_id": "int64", "score": "float64", "vec_id": "int64"})

    found = index.mapInPandas(run, f"query_id long, score double, vec_id long, v {kind}")
    place = F.row_number().over(Window.partitionBy("query_id", F.size("v")).orderBy("score", "vec_id"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("query_id", "v").collect()  # k * SAMPLE rows a dimension


def enough_probes(index: DataFrame, queries: DataFrame, sizes: dict[int, int], k: int, tables: int, least: int) -> dict[int, int]:
    """For each dimension the probes with which the sample's true neighbours share a bucket by RECALL.

    Doubled from ``least`` until they do; where all buckets are probed, all neighbours are found.
    """
    hashers = {dim: CrossPolytope(dim, n) for dim, n in sizes.items()}
    out = {dim: min(least, cp.n_buckets) for dim, cp in hashers.items()}
    short = [dim for dim, cp in hashers.items() if cp.n_buckets > least]
    if not short:
        return out
    # rows of equal id may hold different vectors: one of them is asked
    one = queries.where(F.col("dim").isin(short)).groupBy("dim", "id").agg(F.min("v").alias("v"))
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id"))
    asked = one.withColumn("place", place).where(F.col("place") <= SAMPLE).select("id", "v", "dim").collect()
    at = {(r.dim, r.id): r for r in asked}
    truth = true_neighbours(index, asked, k) if asked else []
    for dim in short:
        pairs = [(at[dim, r.query_id].v, r.v) for r in truth if len(r.v) == dim]
        if not pairs:
            continue
        q, x = (np.array([p[j] for p in pairs], np.float64) for j in (0, 1))
        cp = hashers[dim]
        homes = [cp.buckets(x, t) for t in range(tables)]
        while out[dim] < cp.n_buckets:
            met = np.zeros(len(pairs), bool)
            for t in range(tables):
                left = np.flatnonzero(~met)
                if len(left):
                    met[left] = cp.meets(q[left], t, out[dim], homes[t][left])
            if met.mean() >= RECALL:
                break
            out[dim] = min(2 * out[dim], cp.n_buckets)
    return out


def nearest(vectors: DataFrame, k: int, query_every: int, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by ``query_every`` the k nearest found.

    Nearness is Euclidean distance in double precision; ties go to the smaller id; a query never finds
    its own id. Vectors that are null, zero or hold null or non-finite components take no part, and
    only vectors of equal dimension meet. Rows of equal id and vector count once. Fewer than k
    candidates give fewer rows. ``probes`` is the least number; ``enough_probes`` raises it.
    """
    rows = usable(vectors).distinct()
    # a result shows at most k ids of equal vectors besides the query's own: the k + 1 least suffice
    index = written(_least_ids(rows, k + 1).withColumn("dim", F.size("v")).withColumn("class", F.monotonically_increasing_id()), "vectors")
    sizes = {r.dim: r.n for r in index.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row per dimension
    queries = rows.where(F.col("id") % query_every == 0).withColumn("dim", F.size("v"))

    asks = enough_probes(index, queries, sizes, k, tables, probes)

    def hashed(probing: bool):
        def run(batches):
            for pdf in batches:
                for dim, part in pdf.groupby("dim"):
                    cp = CrossPolytope(int(dim), sizes[int(dim)])
                    x = np.stack(part["v"].to_numpy()).astype(np.float64)
                    for t in range(tables):
                        if not probing:
                            yield pd.DataFrame({"dim": part["dim"], "t": t, "bucket": cp.buckets(x, t), "class": part["class"], "ids": part["ids"], "v": part["v"]})
                            continue
                        n = asks[int(dim)]
                        step = max(1, 100_000 // n)
                        for i in range(0, len(part), step):
                            some = part.iloc[i : i + step]
                            keys = cp.probes(x[i : i + step], t, n)
                            one = pd.DataFrame({"dim": np.repeat(some["dim"].to_numpy(), n), "t": t, "bucket": keys.ravel(), "id": np.repeat(some["id"].to_numpy(), n), "v": np.repeat(some["v"].to_numpy(), n)})
                            yield one[one["bucket"] >= 0]

        return run

    kind = index.schema["v"].dataType.simpleString()
    placed = index.mapInPandas(hashed(False), f"dim int, t int, bucket long, class long, ids array<long>, v {kind}")
    placed = written(placed, "buckets")
    blocks = written(placed.groupBy("dim", "t", "bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "blocks")
    # a query's probes repeat its vector: by their shuffled bytes they look small enough to send to the driver and all tasks, but aren't
    blocks = blocks.hint("broadcast" if blocks.count() <= BROADCAST_ROWS else "merge")
    keys = ["dim", "t", "bucket", "block"]
    left = placed.join(blocks, ["dim", "t", "bucket"]).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    asked = queries.mapInPandas(hashed(True), f"dim int, t int, bucket long, id long, v {kind}")
    asked = asked.join(blocks.withColumnRenamed("blocks", "splits"), ["dim", "t", "bucket"]).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("splits") - 1)))

    def rerank(index_pdf: pd.DataFrame, query_pdf: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(index_pdf) and len(query_pdf):
            x = np.stack(index_pdf["v"].to_numpy()).astype(np.float64)
            members = index_pdf["ids"].to_numpy()
            for q, v in zip(query_pdf["id"].tolist(), query_pdf["v"], strict=True):
                d = np.sqrt(((x - v) ** 2).sum(axis=1))
                # the classes up to the (k + 1)-th distance hold all that can be among the k nearest here
                edge = np.partition(d, k)[k] if len(d) > k + 1 else np.inf
                near = np.flatnonzero(d <= edge)
                found = sorted((d[j], i) for j in near.tolist() for i in members[j] if i != q)[:k]
                out["query_id"] += [q] * len(found)
                out["vec_id"] += [i for _, i in found]
                out["score"] += [s for s, _ in found]
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = left.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(rerank, "query_id long, vec_id long, score double").distinct()
    best = F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k)  # of at most k * tables * (probes that were enough) each
    ranked = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "hit.vec_id", "hit.score")


def _least_ids(rows: DataFrame, n: int) -> DataFrame:
    """v, ids: the n least ids of each distinct vector. Each task passes on n rows of a vector at most
    (the window's limit is pushed below its shuffle), so a common vector gathers in no task."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    return rows.withColumn("place", place).where(F.col("place") <= n).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
