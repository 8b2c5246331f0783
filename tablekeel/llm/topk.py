"""Exact top-k search by inner product, over vectors sorted by length.

All vectors are turned by the singular vectors of their second moments, so that the first
coordinates of each hold most of its length. Queries first meet the longest vectors, which
gives each a score that its k best must reach. Then vectors are dealt into parts and
queries into groups; within a part, vectors come by descending length. A block of them is
done with once the product of lengths cannot reach a query's score (Cauchy-Schwarz); a
vector is passed over if the sum over the first coordinates and the product of the
lengths of the rest cannot. Scores of what is left are computed exactly on integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablekeel.llm.common import cut, pick

#: Rows of one part and one group: what a task holds at a time.
PART_VECTORS, GROUP_QUERIES = 65_536, 8_192
#: The longest vectors that all queries meet first, and rows whose second moments make the rotation.
FIRST_VECTORS, MOMENT_ROWS = 2_048, 20_000
#: Vectors, and queries, that are compared at once within a task.
BLOCK = 1_024


def quantised(vector: Column, factor: int) -> Column:
    """floor(factor * x) of all components, as long; null where the vector or a component is null or not finite."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(as_double, lambda x: F.floor(x * factor).cast("long")))


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of all rows of q and v, integers; by floats only where those hold all sums exactly."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1]
    if most < 2.0**52:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    return q @ v.T


class Best:
    """The k best (score, -id) of each query so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Further candidates: a row, a score and an id for each."""
        old = np.unique(rows)
        rows = np.concatenate([np.repeat(old, self.k), rows])
        score = np.concatenate([self.score[old].ravel(), score])
        ids = np.concatenate([self.id[old].ravel(), ids])
        order = np.lexsort((ids, ~score, rows))  # ~ turns the order of integers round without overflow
        rows, score, ids = rows[order], score[order], ids[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.k
        self.score[rows[keep], place[keep]] = score[keep]
        self.id[rows[keep], place[keep]] = ids[keep]


class Part:
    """Vectors that are turned and sorted by length, for queries to search."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, turn: np.ndarray, head: int) -> None:
        turned = v.astype(np.float64) @ turn
        long = np.sqrt((turned * turned).sum(axis=1))
        order = np.argsort(-long, kind="stable")
        self.v, self.ids, self.long = v[order], ids[order], long[order]
        self.head = turned[order, :head]
        self.rest = np.sqrt((turned[order, head:] ** 2).sum(axis=1))
        self.turn = turn

    def search(self, q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, k: int) -> Best:
        """The k best for each query that reach floor, a score that its k best are known to reach."""
        best, slack, head = Best(len(q), k), 1e-9, self.head.shape[1]
        turned = q.astype(np.float64) @ self.turn
        long, rest = np.sqrt((turned * turned).sum(axis=1)), np.sqrt((turned[:, head:] ** 2).sum(axis=1))
        for at in range(0, len(self.v), BLOCK):
            block = slice(at, at + BLOCK)
            any_left = False
            for first in range(0, len(q), BLOCK):
                some = np.arange(first, min(first + BLOCK, len(q)))
                need = np.maximum(best.score[some, -1], floor[some])
                reach = long[some] * self.long[at]
                alive = reach * (1 + slack) + slack >= need
                some, need, reach = some[alive], need[alive], reach[alive]
                if not len(some):
                    continue
                any_left = True
                bound = turned[some, :head] @ self.head[block].T + rest[some, None] * self.rest[block]
                open_ = bound + slack * (reach[:, None] + 1) >= need[:, None]
                open_ &= q_ids[some, None] != self.ids[block][None, :]
                rows, columns = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
                if not len(rows):
                    continue
                score = _exact(q[some[rows]], self.v[block][columns])
                good = open_[np.ix_(rows, columns)] & (score >= need[rows, None])
                r, c = np.nonzero(good)
                if len(r):
                    best.add(some[rows][r], score[r, c], self.ids[block][columns][c])
            if not any_left:
                break
        return best


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _moments(vectors: DataFrame, dim: int) -> np.ndarray:
    """The turn of vectors of one dimension: singular vectors of a bounded sample, the strongest first."""
    rows = vectors.where(F.size("vector") == dim).select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(MOMENT_ROWS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            x = _matrix(batch.column("vector")).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    parts = [np.frombuffer(r.total).reshape(dim, dim) for r in rows.mapInArrow(sums, "total binary").collect()]
    total = reduce(np.add, parts, np.zeros((dim, dim)))
    return np.linalg.svd(total)[0]


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "vector") -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k best among all other rows, ties to the smaller vec_id.

    vectors: vec_id and an array of long. is_query: a condition on vec_id. Rows with a null
    id, a null vector, or a null in it take no part. Vectors meet only those of the same
    length; an empty vector meets none. Of rows that repeat a query's id with different
    vectors the least vector asks, and none of them is a candidate for it; repeated rows of
    other ids are candidates each. A query with fewer than k candidates returns all.

    Queries are as many as they are: they are met in groups by parts of the vectors, so
    that a task holds PART_VECTORS and GROUP_QUERIES at most, and each row is shuffled
    once for each group or part that it meets.
    """
    rows = pick(vectors, vec_id=vec_id, vector=vector).select(F.col("vec_id").cast("long").alias("vec_id"), "vector")
    rows = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0 AND forall(vector, x -> x IS NOT NULL)")
    rows = rows.withColumn("dim", F.size("vector"))
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min_by(F.struct("vector", "dim"), F.struct("dim", "vector")).alias("q"))
    queries = cut(queries.select(F.col("vec_id").alias("query_id"), "q.vector", "q.dim"))
    asked = {r.dim: r.n for r in queries.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    there = {r.dim: r.n for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    found = [_of_dimension(rows, queries, dim, n, there.get(dim, 0), k) for dim, n in sorted(asked.items())]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best))
    return out.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _of_dimension(rows: DataFrame, queries: DataFrame, dim: int, asked: int, there: int, k: int) -> DataFrame:
    rows, queries = rows.where(F.col("dim") == dim), queries.where(F.col("dim") == dim)
    turn = _moments(rows, dim)
    head = max(1, dim // 4)
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    first = rows.orderBy(F.desc(length), "vec_id").limit(FIRST_VECTORS).select("vec_id", "vector").toArrow()
    first_ids = first.column("vec_id").to_numpy()
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((turn, first_ids, _matrix(first.column("vector"))))
    lowest = np.iinfo(np.int64).min

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, ids, v = shared.value
        for batch in batches:
            for at in range(0, len(batch), GROUP_QUERIES):
                part = batch.slice(at, GROUP_QUERIES)
                q = _matrix(part.column("vector"))
                none = np.full(len(q), lowest)
                best = Part(v, ids, turn, head).search(q, part.column("query_id").to_numpy(), none, k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("query_id"), part.column("vector"), pa.array(best.score[:, -1])], names=["query_id", "vector", "floor"]
                )

    queries = queries.select("query_id", "vector").mapInArrow(floors, "query_id long, vector array<bigint>, floor long")
    # A small table is dealt into enough parts to keep all cores busy.
    groups = -(-asked // GROUP_QUERIES)
    parts = max(-(-there // PART_VECTORS), min(2 * context.defaultParallelism, -(-there // BLOCK)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda c, n: F.pmod(F.xxhash64(c, F.lit(1)), F.lit(n)).cast("int")
    left = queries.withColumn("group", deal("query_id", groups)).withColumn("part", each(parts))
    right = rows.select("vec_id", "vector").withColumn("part", deal("vec_id", parts)).withColumn("group", each(groups))

    def meet(q: pa.Table, v: pa.Table) -> pa.Table:
        found = []
        if q.num_rows and v.num_rows:
            ids = q.column("query_id").to_numpy()
            part = Part(_matrix(v.column("vector")), v.column("vec_id").to_numpy(), shared.value[0], head)
            best = part.search(_matrix(q.column("vector")), ids, q.column("floor").to_numpy(), k)
            there = best.score > lowest
            found = [np.repeat(ids, there.sum(axis=1)), best.id[there], best.score[there]]
        found = found or [np.zeros(0, dtype=np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    cells = left.groupBy("group", "part").cogroup(right.groupBy("group", "part"))
    return cells.applyInArrow(meet, "query_id long, vec_id long, score long")


def oracle(factor: int = 256, every: int = 50, k: int = 5) -> str:
    """The query's result, as DuckDB SQL over embeddings."""
    return f"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.vector, v.vector), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % {every} = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= {k}"""
