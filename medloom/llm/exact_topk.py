"""Exact top-k search by inner product over a pivot-distance index.

Inner products become distances by one more coordinate: with M the largest squared length, vector
x gets sqrt(M - x.x) and a query 0, so |q - x|^2 = q.q + M - 2 q.x. Each vector is keyed by its
nearest pivot and its distance to it; the vectors of a pivot are cut into rings (annuli) by
distance, and rings into blocks of bounded size. A query first searches the rings around its own
distance to its nearest pivots, which gives a bound for its k-th best; then the rings of all pivots
that the triangle inequality does not rule out under that bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom.llm._common import written

SCALE = 256
TOP = 5
QUERY_EVERY = 50
# Larger components do not fit a long as integers, and their products are no scores.
MOST_COMPONENT = float(1 << 54)
# Pivots are fitted on a sample of this many vectors; every vector is indexed.
FIT_VECTORS = 5000
PIVOTS = 64
RINGS = 16
# Vectors in a block and queries in a group that meet in one task.
BLOCK = 2048
GROUP = 2048
# Pivots whose own ring is searched first.
FIRST_PIVOTS = 2
# Distances are computed in double precision: bounds give way by this share. Squares beyond 2^53
# are rounded, so their differences are further off.
SLACK, ROUNDED_SLACK = 1e-9, 1e-6


def whole_vectors(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v, asks``: vectors as integers floor(SCALE * x); unusable ones are left out, and a
    finite component of 2^54 or more is an error."""
    v = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(id_col).isNotNull()
        & v.isNotNull()
        & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    too_large = F.raise_error(F.lit("component too large for a score")).cast("bigint")
    whole = F.transform(v, lambda x: F.when(F.abs(x) < MOST_COMPONENT, F.floor(x * SCALE)).otherwise(too_large))
    asks = F.coalesce(is_query.cast("boolean"), F.lit(False)).alias("asks")
    return vectors.where(usable).select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("v"), asks)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, float) if rows else np.empty((0, 0))


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the coordinate that makes all of them equally long."""
    return np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def fit_pivots(vectors: DataFrame, most: float, pivots: int) -> np.ndarray:
    """Centres of the sampled vectors (the first by a hash of the id), by a few rounds of k-means."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_VECTORS).collect()
    x = _lifted(np.array([r["v"] for r in sample], float), most)
    centres = x[np.linspace(0, len(x) - 1, min(pivots, len(x))).astype(int)]
    for _ in range(8):
        own = _distances(x, centres).argmin(axis=1)
        centres = np.array([x[own == k].mean(axis=0) if (own == k).any() else c for k, c in enumerate(centres)])
    return centres


def _keyed(vectors: DataFrame, pivots: np.ndarray, most: float) -> DataFrame:
    """``vec_id, v, pivot, d``: nearest pivot and distance to it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                d = _distances(_lifted(_matrix(batch["v"]), most), pivots)
                own = d.argmin(axis=1)
                near = d[np.arange(len(d)), own]
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["v"], pa.array(own.astype(np.int32)), pa.array(near)],
                    names=["vec_id", "v", "pivot", "d"],
                )

    return vectors.mapInArrow(run, "vec_id long, v array<bigint>, pivot int, d double")


def _ring(edges: dict[int, list[float]]) -> Column:
    """The ring of ``d`` among its pivot's: how many of the pivot's edges lie below it."""
    table = F.create_map(*[c for p, e in edges.items() for c in (F.lit(p), F.array(*[F.lit(float(x)) for x in e]))])
    return F.size(F.filter(F.element_at(table, F.col("pivot")), lambda e: e < F.col("d")))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    top: int = TOP,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the highest inner products of each query, itself left out.

    Ties go to the smaller id; a query with fewer candidates returns all. Vectors that are null,
    empty, or hold a null, NaN or infinite component take no part, neither do null ids; vectors of
    another length than the others are an error, and so are scores that fit no long. Rows that repeat an id are one candidate each; as a
    query they count once, with the smallest vector, and leave out every row of their own id. Other
    columns are not read.
    """
    asked = written(whole_vectors(vectors, is_query, id_col, vector_col), "vectors")
    whole = asked.select("vec_id", "v")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    most = whole.agg(F.max(squares)).first()[0]
    schema = "query_id long, rank int, vec_id long, score long"
    if most is None:
        return vectors.sparkSession.createDataFrame([], schema)
    centres = fit_pivots(whole, most, pivots)
    keyed = _keyed(whole, centres, most)
    quantiles = [k / RINGS for k in range(1, RINGS)]
    edges = {
        r["pivot"]: sorted(set(r["e"]))
        for r in keyed.groupBy("pivot").agg(F.percentile_approx("d", quantiles, 1000).alias("e")).collect()
    }
    keyed = keyed.withColumn("ring", _ring(edges))
    # A ring may hold many equal vectors: it is cut into as many blocks as its size asks for.
    sizes = {
        (r["pivot"], r["ring"]): (r["least"], r["most"], -(-r["n"] // BLOCK))
        for r in keyed.groupBy("pivot", "ring")
        .agg(F.count("*").alias("n"), F.min("d").alias("least"), F.max("d").alias("most"))
        .collect()  # at most PIVOTS * RINGS rows
    }
    per_ring = F.create_map(*[c for (p, r), (_, _, n) in sizes.items() for c in (F.lit(p * RINGS + r), F.lit(n))])
    cell = F.col("pivot") * RINGS + F.col("ring")
    index = keyed.select(
        "vec_id", "v", cell.alias("cell"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.element_at(per_ring, cell)).alias("salt")
    )
    index = written(index, "pivot-index")

    queries = asked.where("asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    queries = written(queries, "queries")
    groups = max(1, -(-queries.count() // GROUP))
    rings = _Rings(sizes, centres, most, top)

    unbounded = queries.withColumn("kth", F.lit(None).cast("bigint"))
    first = _searched(index, unbounded, _routes(queries, rings, None), groups, top, most)
    bounds = _best(first, top).groupBy("query_id").agg(
        F.when(F.count("*") == top, F.min("score")).alias("kth")
    )
    bounds = written(bounds, "bounds")
    bounded = queries.join(bounds, "query_id", "left")
    rest = _searched(index, bounded, _routes(bounded, rings, "kth"), groups, top, most)
    return _best(first.union(rest), top).select("query_id", F.col("place").alias("rank"), "vec_id", "score")


class _Rings:
    """The directory of rings: PIVOTS * RINGS entries whatever the number of vectors."""

    def __init__(self, sizes: dict, centres: np.ndarray, most: float, top: int):
        keys = sorted(sizes)
        self.pivot = np.array([p for p, _ in keys])
        self.cell = np.array([p * RINGS + r for p, r in keys])
        self.least, self.most_d, self.blocks = (np.array([sizes[k][i] for k in keys]) for i in range(3))
        self.centres, self.most = centres, most

    def near(self, q: np.ndarray) -> np.ndarray:
        """The ring around the query's distance, of each of its nearest pivots."""
        d = _distances(q, self.centres)
        chosen = np.zeros((len(q), len(self.cell)), bool)
        for i in range(len(q)):
            for p in np.argsort(d[i])[:FIRST_PIVOTS]:
                own = np.flatnonzero(self.pivot == p)
                if len(own):
                    away = np.maximum(self.least[own] - d[i, p], d[i, p] - self.most_d[own])
                    chosen[i, own[away.argmin()]] = True
        return chosen

    def reach(self, q: np.ndarray, kth: np.ndarray) -> np.ndarray:
        """All rings that may hold a vector as good as the k-th best so far."""
        radius = np.sqrt(np.maximum((q * q).sum(axis=1) + self.most - 2 * kth, 0))
        d = _distances(q, self.centres)[:, self.pivot]
        share = SLACK if self.most < 2**53 else ROUNDED_SLACK
        slack = share * (d + radius[:, None] + np.sqrt(self.most)) + 1e-6
        return (self.least - slack <= d + radius[:, None]) & (self.most_d + slack >= d - radius[:, None])


def _routes(queries: DataFrame, rings: _Rings, bound: str | None) -> DataFrame:
    """``query_id, cell, salt``: the blocks that each query searches (in this step)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            q = np.pad(_matrix(batch["v"]), ((0, 0), (0, 1)))
            chosen = rings.near(q)
            if bound:
                kth = np.array([-np.inf if x is None else x for x in batch[bound].to_pylist()], float)
                chosen = rings.reach(q, kth) & ~chosen  # the near ones are done
            i, ring = np.nonzero(chosen)
            blocks = rings.blocks[ring].astype(int)
            at = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            of = np.repeat(i, blocks)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["query_id"].take(pa.array(of)),
                    pa.array(rings.cell[np.repeat(ring, blocks)].astype(np.int32)),
                    pa.array(at.astype(np.int64)),
                ],
                names=["query_id", "cell", "salt"],
            )

    return queries.mapInArrow(run, "query_id long, cell int, salt long")


def _searched(
    index: DataFrame, queries: DataFrame, routes: DataFrame, groups: int, top: int, most: float
) -> DataFrame:
    """The best of each searched block for each query, as far as they reach the query's bound ``kth``.
    Blocks and query groups are of bounded size."""
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int").alias("group")
    asked = queries.join(routes, "query_id").select("cell", "salt", group, "query_id", "v", "kth")
    # A block that queries of several groups ask for is sent once to each.
    wanted = asked.select("cell", "salt", "group").distinct()
    block_key = [F.col(k).alias(f"block_{k}") for k in ("cell", "salt", "group")]
    sent = index.join(wanted, ["cell", "salt"]).select("vec_id", "v", *block_key)
    key = ["cell", "salt", "group"]
    # Products are whole numbers of at most ``most``: exact in doubles up to 2^53, in longs up to
    # 2^63, beyond that in Python's own (a best score that fits no long is an error).
    kind = np.float64 if most < 2**53 else np.int64 if most < 2**62 else object

    def run(block: pa.Table, asking: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(block) and len(asking):
            ids, x = block["vec_id"].to_numpy(), np.array(block["v"].to_pylist(), kind)
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], x[order]
            scores = np.array(asking["v"].to_pylist(), kind) @ x.T
            for q, kth, row in zip(asking["query_id"].to_pylist(), asking["kth"].to_pylist(), scores):
                others = ids != q
                ids_of, row = ids[others], row[others]
                # Stable order: among equal scores the smaller id comes first.
                if len(row) > 4 * top:
                    least = np.partition(row, -top)[-top] if kind is not object else sorted(row)[-top]
                    some = np.flatnonzero(row >= least)
                else:
                    some = np.arange(len(row))
                best = some[np.argsort(-row[some], kind="stable")[:top]]
                if kth is not None:
                    best = best[row[best] >= kth]
                out["query_id"] += [q] * len(best)
                out["vec_id"] += ids_of[best].tolist()
                out["score"] += row[best].astype(np.int64).tolist()
        return pa.table({k: pa.array(c, pa.int64()) for k, c in out.items()})

    schema = "query_id long, vec_id long, score long"
    found = sent.groupBy(*[f"block_{k}" for k in key]).cogroup(asked.groupBy(*key)).applyInArrow(run, schema)
    return written(found, "found")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


SQL = f"""
WITH w AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM w AS q JOIN w AS c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}"""
