"""Exact highest inner products by the threshold algorithm.

Method: candidates are dealt into blocks by a hash. A block sorts every dimension once. For each query the
lists are read from their better end (the upper one where the query's component is positive), a few rows of
every list at a time; rows seen for the first time are scored in full. Reading stops when the bound, the
query times the next unread value of each list, can no longer reach the k-th best score: no unread
row can beat it, nor tie with it and have a smaller id. The best k of all blocks are then ranked.

Queries are dealt into groups as well, so a task holds one block and one group of queries, whatever the
table's size. Scores are exact integers: floats while all products fit in 53 bits, else unlimited integers.
Blocks rank by these; a score beyond 64 bits is reported as the nearest of 64, and such scores of different
blocks then rank by id.

Vectors that are null, or hold null or non-finite components, and rows with a null id take no part.
Missing components of a shorter vector count as zero. Exactly repeated rows count once; an id that has
several vectors is reported once, with its best score. A query never finds its own id. Fewer than k
candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 16_384
QUERY_GROUP = 8_192
STEPS = 96  # steps in which a block's lists would be read to their ends
FOUND = "query_id long, vec_id long, score long"


def usable(frame: DataFrame) -> DataFrame:
    """vec_id and its vector as doubles, distinct."""
    return (
        frame.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        .where("vec_id is not null and vector is not null")
        .where("not exists(vector, x -> x is null or isnan(x) or abs(x) = double('Infinity'))")
        .distinct()
    )


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """floor(256 * x), padded with zeros; unlimited integers where floats would not be exact."""
    column = table.column("vector").combine_chunks()
    flat = np.floor(256 * column.flatten().to_numpy())
    sizes = np.diff(column.offsets.to_numpy())
    if len(flat) and np.abs(flat).max() >= 2**53:
        flat = np.array([int(x) for x in flat], object)
    out = np.zeros((len(sizes), width), flat.dtype if len(flat) else np.float64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _better(score, ids, k: int, repeats: bool) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; if ids repeat, of their best scores."""
    order = np.lexsort((ids, -score))
    if repeats:
        order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
    return order[:k]


class SortedLists:
    """One block: every dimension's rows from the smallest value to the largest."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.repeats = len(np.unique(ids)) < len(ids)
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own``."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = self.ids == own
        left = n - int(seen.sum())
        ids, scores = np.zeros(0, np.int64), np.zeros(0, query.dtype)
        step = max(k, n // STEPS)
        depth = 0
        while left and depth < n:
            end = min(n, depth + step)
            fresh = np.concatenate((self.order[up, n - end : n - depth].ravel(), self.order[down, depth:end].ravel()))
            if len(up) + len(down) == 0:  # a zero query: all scores are zero, so all rows are read
                fresh, end = np.arange(n), n
            fresh = fresh[~seen[fresh]]
            if len(fresh):
                seen[fresh] = True
                fresh = np.unique(fresh)
                left -= len(fresh)
                ids = np.concatenate((ids, self.ids[fresh]))
                scores = np.concatenate((scores, self.vectors[fresh] @ query))
                top = _better(scores, ids, k, self.repeats)
                ids, scores = ids[top], scores[top]
            depth = end
            if depth < n and len(ids) == k:
                bound = query[up] @ self.values[up, n - 1 - depth] + query[down] @ self.values[down, depth]
                if scores[-1] > bound:
                    break
        return ids, scores


def _search(k: int):
    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if candidates.num_rows and queries.num_rows:
            width = max(max(len(x) for x in t.column("vector")) for t in (candidates, queries))
            rows, wanted = _matrix(candidates, width), _matrix(queries, width)
            size = max((float(np.abs(m).max()) if m.size else 0.0) for m in (rows, wanted))
            if rows.dtype != wanted.dtype or size * size * max(1, width) >= 2**53:
                rows, wanted = (np.array([[int(x) for x in r] for r in m], object).reshape(m.shape) for m in (rows, wanted))
            lists = SortedLists(candidates.column("vec_id").to_numpy(), rows)
            for own, query in zip(queries.column("vec_id").to_pylist(), wanted, strict=True):
                ids, scores = lists.best(query, own, k)
                found += [
                    (own, i, max(-(2**63), min(2**63 - 1, int(s)))) for i, s in zip(ids.tolist(), scores, strict=True)
                ]
        return pa.table({n: pa.array([x[i] for x in found], pa.int64()) for i, n in enumerate(("query_id", "vec_id", "score"))})

    return search


def search(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row that ``is_query`` picks."""
    rows = usable(vectors)
    counts = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, groups = max(1, -(-counts.n // BLOCK)), max(1, -(-counts.q // QUERY_GROUP))
    spread = F.xxhash64("vec_id", "vector")
    dealt = rows.withColumn("block", F.pmod(spread, F.lit(blocks))).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    )
    asked = (
        rows.where(is_query)
        .withColumn("part", F.pmod(spread, F.lit(groups)))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    )
    found = (
        dealt.groupBy("block", "part")
        .cogroup(asked.groupBy("block", "part"))
        .applyInArrow(_search(k), FOUND)
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
