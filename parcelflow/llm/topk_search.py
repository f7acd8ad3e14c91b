"""Operator 4: exact top-k inner product by pivot-table elimination.

Vectors become integers, floor(1024 x).  A few pivots are picked farthest-first
from a bounded sample, and each vector's distances to all pivots are computed once
and stored: the pivot table.  For a query q and a candidate c the triangle
inequality gives max over pivots |d(q, p) - d(c, p)| <= d(q, c), and so an upper
bound of the inner product (|q|^2 + |c|^2 - d^2) / 2.  Candidates are evaluated in
the order of this bound until the next bound lies below the k-th best score: then
no other candidate can enter, and the search stops.

Candidates are dealt into blocks by a hash of the id, queries into blocks of their
own; each pair of a query block and a candidate block is one task, and the k best
of each query and block are merged.  A task holds two blocks, whatever the table's
size, and every vector is indexed.

Defined results: a vector that is NULL or holds NULL or non-finite components, or
has a NULL id, takes no part; vectors of different lengths have no score; repeated
rows (same id and vector) count once; of rows with one id and different vectors
each is a candidate, and as a query the id takes the best over all; a candidate
with the query's id is the query itself.  Only the id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.llm.common import on_executors, table
from parcelflow.llm.vectors import matrix, usable
from parcelflow.session import stored

K = 10
PIVOTS = 32
#: Vectors the pivots are picked from, at most.
PIVOT_SAMPLE = 2_000
#: Candidates and queries in one block, at most.  The larger the blocks, the fewer
#: copies of each are sent (rows sent: n * queries * (1 / BLOCK + 1 / QUERY_BLOCK)).
BLOCK, QUERY_BLOCK = 32_768, 16_384
#: Candidates in one block, at least, where the table is too small for a task in
#: each shuffle partition.
LEAST_BLOCK = 2_048
STEP = 128


def farthest_first(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows, each as far as can be from those before it."""
    if not len(points):
        return points
    picked = [0]
    nearest = np.linalg.norm(points - points[0], axis=1)
    while len(picked) < n and nearest.max() > 0:
        picked.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, np.linalg.norm(points - points[picked[-1]], axis=1))
    return points[picked]


def pivot_table(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``vectors`` (vec_id, y) with ``d``: the distances to the pivots."""

    def run(batches):
        for b in batches:
            length = b.column("y").value_lengths().to_numpy()
            order, out = np.argsort(length, kind="stable"), [None] * b.num_rows
            for n in np.unique(length):
                at = order[np.searchsorted(length[order], n):
                           np.searchsorted(length[order], n, "right")]
                y = matrix(b.column("y").take(pa.array(at)))
                p = pivots.get(int(n), np.zeros((0, int(n))))
                d = np.stack([np.linalg.norm(y - q, axis=1) for q in p], axis=1) \
                    if len(p) else np.zeros((len(at), 0))
                for i, row in zip(at, d, strict=True):
                    out[i] = row
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("y"), pa.array(out, pa.list_(pa.float64()))],
                ["vec_id", "y", "d"])

    return on_executors(vectors).mapInArrow(run, "vec_id long, y array<long>, d array<double>")


def inner(y: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products: in doubles while those are exact, else in Python
    integers held to the range of a long."""
    if exact:
        return (y @ q).astype(np.int64)
    wide = y.astype(object) @ q.astype(object)
    return np.array([min(max(int(v), -2**63), 2**63 - 1) for v in wide], np.int64)


def search_block(ids: np.ndarray, y: np.ndarray, d: np.ndarray, queries: np.ndarray,
                 qy: np.ndarray, qd: np.ndarray, k: int):
    """(query, candidate, score) of each query's k best in the block."""
    norm, qnorm = (y * y).sum(axis=1), (qy * qy).sum(axis=1)
    largest = max(np.abs(y).max(initial=0), np.abs(qy).max(initial=0))
    exact = bool(largest ** 2 * max(y.shape[1], 1) < 2**53)
    for i in range(len(queries)):
        gap = np.abs(d - qd[i]).max(axis=1) if d.shape[1] else np.zeros(len(ids))
        bound = (norm + qnorm[i] - gap * gap) / 2
        bound += 1e-9 * (norm + qnorm[i]) + 1  # rounding of the distances
        order = np.argsort(-bound, kind="stable")
        order = order[ids[order] != queries[i]]
        best_id, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(order), STEP):
            if len(best) >= k and bound[order[at]] < best[-1]:
                break
            some = order[at:at + STEP]
            best_id = np.r_[best_id, ids[some]]
            best = np.r_[best, inner(y[some], qy[i], exact)]
            top = np.lexsort((best_id, -best.astype(np.float64) if exact else
                              np.array([-int(v) for v in best], object)))[:k]
            best_id, best = best_id[top], best[top]
        yield from zip([int(queries[i])] * len(best), best_id.tolist(), best.tolist(),
                       strict=True)


def top_k(vectors: DataFrame, query_every: int = 100, k: int = K, pivots: int = PIVOTS,
          block: int = BLOCK, query_block: int = QUERY_BLOCK, vec_id: str = "vec_id",
          embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score for the ids divisible by ``query_every``."""
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"),
                          vectors[embedding].alias("v"))
    ints = (rows.filter(F.col("vec_id").isNotNull() & usable("v"))
            .select("vec_id", F.transform("v", lambda x: F.floor(1024 * x.cast("double")))
                    .alias("y")).distinct())
    indexed = stored(ints, "integers")
    n = indexed.count()
    sample = indexed.orderBy(F.xxhash64("vec_id", F.lit(7)), "vec_id").limit(PIVOT_SAMPLE)
    by_length: dict[int, list] = {}
    for r in sample.select("y").collect():
        by_length.setdefault(len(r.y), []).append(r.y)
    picked = {m: farthest_first(np.array(p, np.float64), pivots) for m, p in by_length.items()}
    held = stored(pivot_table(indexed, picked)
                  .withColumns({"dim": F.size("y"), "is_query": F.col("vec_id") % query_every == 0}),
                  "pivots")
    n_queries = held.filter("is_query").count()
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n // block), min(partitions, -(-n // LEAST_BLOCK)))
    query_blocks = max(1, -(-n_queries // query_block))
    spread = lambda m, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(m))
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    columns = ["dim", "block", "query_block", "vec_id", "y", "d"]
    candidates = (held.withColumn("block", spread(blocks, 1))
                  .withColumn("query_block", every(query_blocks)))
    queries = (held.filter("is_query").withColumn("query_block", spread(query_blocks, 2))
               .withColumn("block", every(blocks)))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = list(search_block(
                left.column("vec_id").to_numpy(), matrix(left.column("y")),
                matrix(left.column("d")), right.column("vec_id").to_numpy(),
                matrix(right.column("y")), matrix(right.column("d")), k))
        columns_ = zip(*found, strict=True) if found else ([], [], [])
        return pa.table([pa.array(list(c), pa.int64()) for c in columns_], schema=schema)

    key = ["dim", "block", "query_block"]
    best = (candidates.select(columns).groupBy(key).cogroup(queries.select(columns).groupBy(key))
            .applyInArrow(run, "query_id long, vec_id long, score long"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS y
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_inner_product(q.y, c.y)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.y) = len(c.y)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
       AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""
