"""Operator 7: embedding near-dedup in spherical k-means cells.

Equal vectors of one label form a class; its smallest id stands for it.  Spherical
k-means, fitted on a bounded sample, assigns every representative to the cell of
its most similar centroid.  Two vectors with cosine t are at most
e = sqrt(2 - 2t) apart on the unit sphere, and so the home centroid u of one is
beaten for the other by another centroid v by at most e |u - v|: a vector is also
shown to every cell before its home that it could have such a neighbour in, and no
link across a cell border is lost.  As the centroids that go to every task are bounded,
cells outgrow their size on large tables: such a cell is cut again, by centroids fitted on
a bounded sample of its own and known to its tasks only, in the same way.  Inside a cell,
blocks of a fixed size are compared pairwise by products in double precision; a pair
counts where, on each level, one of the two is at home, and so in one cell only.  A block pair returns link counts and a
forest of the links, not the pairs.  The components of the forests are the groups;
the smallest id of each is kept.

Defined results: a NULL, zero, NULL-holding or non-finite vector, or one with a
NULL label, links with nothing and is kept; a row with a NULL id has no component
and is not kept; vectors of different lengths don't link; repeated rows are vectors
of their own that link with each other.  Only the id, vector and label columns are
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import on_executors, table
from parcelflow.llm.graph import connected_components
from parcelflow.llm.vectors import matrix, usable
from parcelflow.session import stored

THRESHOLD = 0.98
#: Vectors the centroids are fitted on, at most; vectors a cell should hold.
FIT_SAMPLE, CELL = 10_000, 8_192
#: Centroids at most, of the table and of a cell that is cut again: they go to every
#: task of these.
MOST_CELLS = 1_024
#: Vectors of a cell that one task deals to the cells within it.
DEALT = 100_000
ROUNDS = 10
BLOCK = 4_096
STEP = 256


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither over- nor underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=np.finfo(float).tiny)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit points; a cell that runs empty keeps its centroid."""
    start = np.random.default_rng(5).permutation(len(points))[:k]
    centroids = points[start]
    for _ in range(rounds):
        cell = (points @ centroids.T).argmax(axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, cell, points)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        centroids = np.where(length > 1e-12, total / np.maximum(length, 1e-12), centroids)
    return centroids


def cells(reps: DataFrame, centroids: dict[int, np.ndarray], reach: float) -> DataFrame:
    """label, dim, cell, node, copies, home, v: each vector in its home cell and in
    those cells before it that lie within ``reach``."""
    kind = reps.schema["v"].dataType.simpleString()

    def run(batches):
        for b in batches:
            length = b.column("v").value_lengths().to_numpy()
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                c = centroids.get(int(n))
                if c is None:
                    row, cell, home = at, np.zeros(len(at), np.int64), np.ones(len(at), bool)
                else:
                    apart = np.linalg.norm(c[:, None] - c[None], axis=2)
                    sims = unit(matrix(b.column("v").take(pa.array(at)))) @ c.T
                    first = sims.argmax(axis=1)
                    lead = sims[np.arange(len(at)), first][:, None] - sims
                    shown = lead <= reach * apart[first] + 1e-9
                    i, cell = np.nonzero(shown & (np.arange(len(c)) <= first[:, None]))
                    row, home = at[i], cell == first[i]
                took = b.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [took.column("label"), pa.array(np.full(len(row), n), pa.int32()),
                     pa.array(cell, pa.int64()), took.column("node"), took.column("copies"),
                     pa.array(home), took.column("v")],
                    ["label", "dim", "cell", "node", "copies", "home", "v"])

    return on_executors(reps.select("label", "node", "copies", "v")).mapInArrow(
        run, f"label long, dim int, cell long, node long, copies long, home boolean, v {kind}")


def inner_cells(placed: DataFrame, cell_size: int, reach: float) -> DataFrame:
    """The rows of :func:`cells` with ``inner``, ``at_home``: those of cells of more than
    twice ``cell_size`` in cells within the cell, dealt like the cells themselves."""
    keys = ["label", "dim", "cell"]
    sizes = stored(placed.groupBy(*keys).agg(F.count("*").alias("n"))
                   .filter(F.col("n") > 2 * cell_size), "large-cells")
    whole = placed.withColumns({"inner": F.lit(0).cast("long"), "at_home": F.lit(True)})
    if sizes.isEmpty():
        return whole
    picked = F.pmod(F.xxhash64("node", F.lit(9)), F.lit(1 << 30)) < F.lit(FIT_SAMPLE) / F.col("n") * (1 << 30)
    points = F.transform("v", lambda x: x.cast("double"))
    fitted = pa.schema([("label", pa.int64()), ("dim", pa.int32()), ("cell", pa.int64()),
                        ("centroids", pa.list_(pa.list_(pa.float64())))])

    def fit(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        k = min(MOST_CELLS, -(-rows.column("n")[0].as_py() // cell_size))
        found = spherical_kmeans(unit(matrix(rows.column("v"))), k)
        return pa.table([[key[0].as_py()], [key[1].as_py()], [key[2].as_py()], [found.tolist()]],
                        schema=fitted)

    centroids = stored(placed.join(sizes, keys).filter(picked).select(
        *keys, "node", "n", points.alias("v")).groupBy(*keys).applyInArrow(
        fit, "label long, dim int, cell long, centroids array<array<double>>"), "inner-centroids")
    parts = F.ceil(F.col("n") / F.lit(DEALT)).cast("int")
    rows = placed.join(sizes, keys).withColumn("part", F.pmod(F.xxhash64("node", "home"), parts)
                                               .cast("int")).drop("n")
    known = centroids.join(sizes, keys).select(*keys, "centroids", F.explode(
        F.sequence(F.lit(0), parts - 1)).alias("part"))

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.drop_columns(["part"])
        if right.num_rows:
            c = np.array(right.column("centroids")[0].as_py())
            apart = np.linalg.norm(c[:, None] - c[None], axis=2)
            sims = unit(matrix(left.column("v"))) @ c.T
            first = sims.argmax(axis=1)
            lead = sims[np.arange(len(first)), first][:, None] - sims
            shown = lead <= reach * apart[first] + 1e-9
            row, inner = np.nonzero(shown & (np.arange(len(c)) <= first[:, None]))
            at_home = inner == first[row]
        else:  # no vector of the cell fell into the sample
            row = np.arange(left.num_rows)
            inner, at_home = np.zeros(len(row), np.int64), np.ones(len(row), bool)
        return (left.take(pa.array(row)).append_column("inner", pa.array(inner, pa.int64()))
                .append_column("at_home", pa.array(at_home)))

    kind = placed.schema["v"].dataType.simpleString()
    cut = rows.groupBy(*keys, "part").cogroup(known.groupBy(*keys, "part")).applyInArrow(
        deal, f"label long, dim int, cell long, node long, copies long, home boolean, v {kind}, "
              "inner long, at_home boolean")
    return whole.join(sizes.select(*keys), keys, "left_anti").select(*cut.columns).unionByName(cut)


def compare_blocks(threshold: float):
    schema = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lo, hi = key[4].as_py(), key[5].as_py()
        rows = rows.sort_by("node")
        node, copies, home, at_home, block = (rows.column(c).to_numpy() for c in (
            "node", "copies", "home", "at_home", "block"))
        u = unit(matrix(rows.column("v")))
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        links, group = np.zeros(len(node), np.int64), np.arange(len(node))
        for at in range(0, len(left), STEP):
            some = left[at:at + STEP]
            close = u[some] @ u[right].T >= threshold
            close &= home[some][:, None] | home[right]
            close &= at_home[some][:, None] | at_home[right]
            if lo == hi:
                close &= some[:, None] != right
            links[some] += close @ copies[right]
            if lo != hi:
                links[right] += copies[some] @ close
            for i in np.flatnonzero(close.any(axis=1)):
                joined = np.unique(group[np.r_[some[i], right[close[i]]]])
                if len(joined) > 1:
                    group[np.isin(group, joined)] = joined[0]
        touched = (links > 0) | (group != np.arange(len(node)))
        return pa.table([pa.array(node[touched]), pa.array(links[touched]),
                         pa.array(node[group[touched]])], schema=schema)

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, cell_size: int = CELL,
                    block: int = BLOCK, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``."""
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"),
                          vectors[label].cast("long").alias("label"),
                          vectors[embedding].alias("v"))
    some = F.exists("v", lambda x: x != 0)
    joins = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("v") & some
    marked = rows.select("vec_id", "label", "v", F.coalesce(joins, F.lit(False)).alias("joins"))
    classes = stored(marked.filter("joins").groupBy("label", "v")
                     .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "classes")
    n = classes.count()
    by_length: dict[int, list] = {}
    for r in classes.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(FIT_SAMPLE).select(
            "v").collect():
        by_length.setdefault(len(r.v), []).append(r.v)
    k = min(MOST_CELLS, -(-n // cell_size)) if n else 1
    centroids = {m: spherical_kmeans(unit(np.array(p, np.float64)), k)
                 for m, p in by_length.items()}
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    placed = stored(inner_cells(stored(cells(classes, centroids, reach), "cells"), cell_size,
                                reach), "inner-cells")
    keys = ["label", "dim", "cell", "inner"]
    sizes = stored(placed.groupBy(*keys).agg(
        F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")), "sizes")
    dealt = (placed.join(sizes, keys)
             .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
             .select(*keys, "lo", "hi", "block", "node", "copies", "home", "at_home", "v"))
    found = stored(dealt.groupBy(*keys, "lo", "hi").applyInArrow(
        compare_blocks(threshold), "node long, links long, root long"), "links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("node").alias("src"),
                                               F.col("root").alias("dst")))
    h1, h2 = F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit("second"), "v", "label").alias("h2")
    result = stored(classes.select(h1, h2, "node", "copies").join(linked, "node", "left")
                    .join(joined, "node", "left").select(
                        "h1", "h2", F.coalesce("component", "node").alias("component"),
                        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")),
                    "near")
    own = marked.select("vec_id", F.when(F.col("joins"), h1).alias("h1"),
                        F.when(F.col("joins"), h2).alias("h2"))
    component = F.coalesce("component", "vec_id")
    return own.join(result, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
found AS (
  SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
         least(e.vec_id, (SELECT min(b) FROM reach r WHERE r.a = e.vec_id)) AS component_id
  FROM embeddings e)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found
"""
