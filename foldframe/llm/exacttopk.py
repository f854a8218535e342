"""Exact top-k search by aggregation without random access.

Every component is a list of the candidates sorted by value. A query reads each
list from the end that adds most to its score, all lists to the same depth. What
has been read gives a candidate's lower bound (unread components at their
worst) and upper bound (unread ones at the value where reading stands). A
candidate whose upper bound lies below the k-th best lower bound is out; when
few are left, or all is read, their final scores are resolved. Candidates are
searched in blocks, and the blocks' answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .vectors import best_of, distinct_vectors, matrix, takes_part, usual_length

BLOCK, QUERY_BLOCK = 4096, 2048
# queries whose bounds are held at once
HELD = 256
# depths at which bounds are taken, as shares of a list
DEPTHS = (0.5, 0.75, 0.9, 1.0)


class SortedLists:
    """A block's lists: values by component, largest first, and each candidate's place in them."""

    def __init__(self, x: np.ndarray):
        order = np.argsort(-x, axis=0, kind="stable")
        self.x, self.values = x.astype(np.float64), np.take_along_axis(x, order, 0).astype(np.float64)
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(len(x))[:, None].repeat(x.shape[1], 1), 0)

    def bounds(self, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (candidates x queries) after reading `depth` entries of
        every list. All numbers are integers below 2**53, so they are exact."""
        n, up, down = len(self.x), np.maximum(q, 0), np.minimum(q, 0)
        top, bottom = (self.place < depth).astype(np.float64), (self.place >= n - depth).astype(np.float64)
        known = (self.x * top) @ up.T + (self.x * bottom) @ down.T
        if depth >= n:
            return known, known
        v = self.values
        high = (1 - top) @ (up * v[depth - 1]).T + (1 - bottom) @ (down * v[n - depth]).T
        low = (1 - top) @ (up * v[-1]).T + (1 - bottom) @ (down * v[0]).T
        return known + low, known + high


def search_block(x: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (index): candidates that may be among its `k` best, ties included,
    and their scores."""
    lists = SortedLists(x)
    todo = np.arange(len(q))
    for share in DEPTHS:
        depth = max(1, int(np.ceil(share * len(x))))
        later = []
        for at in range(0, len(todo), HELD):
            part = todo[at:at + HELD]
            low, high = lists.bounds(q[part].astype(np.float64), depth)
            kth = np.partition(low, len(x) - k, axis=0)[len(x) - k] if len(x) > k else np.full(len(part), -np.inf)
            live = high >= kth
            for j, i in enumerate(part.tolist()):
                rows = np.flatnonzero(live[:, j])
                if depth >= len(x) or len(rows) <= 4 * k:
                    yield i, rows, x[rows] @ q[i]
                else:
                    later.append(i)
        todo = np.array(later, dtype=np.int64)
        if not len(todo):
            return


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, dim: int | None = None) -> DataFrame:
    """The `k` highest scores of every query row: query_id, rank (from 1), vec_id, score.

    `vectors` needs vec_id and embedding; other columns are ignored. A component x
    counts as floor(scale * x) in double precision, the score is the integer inner
    product, equal scores go by the smaller vec_id, and candidates are all rows but the
    query's own. Vectors that are null, hold null or non-finite components or differ in
    length from `dim` (default: the most frequent length) take no part. Equal integer
    vectors are searched once, with their k + 1 smallest ids. Rows with a
    null vec_id take no part; rows of one vec_id are separate candidates, equal ones
    one query, which leaves out all of its own id. Components so large that a score could reach 2**53 raise.
    An empty table gives an empty result."""
    dim = dim or usual_length(vectors, "embedding")
    rows = saved(vectors.where(takes_part(F.col("embedding"), dim, False) & F.col("vec_id").isNotNull())
                 .select(F.col("vec_id").cast("long").alias("vec_id"),
                         F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vec"),
                         F.coalesce(is_query, F.lit(False)).alias("is_query")), "topk-rows")
    distinct, queries = distinct_vectors(rows, k + 1)
    n, nq, most = distinct.agg(F.count(F.lit(1)), F.count(F.when(F.col("asked"), 1)),
                               F.max(F.array_max(F.transform("vec", lambda v: F.abs(v.cast("double")))))).first()
    if dim * (most or 0.0) ** 2 >= 2.0 ** 53:
        raise ValueError(f"a component of {most:g} in {dim} dimensions can give scores of 2**53 and more")
    bx, bq = max(1, -(-n // BLOCK)), max(1, -(-nq // QUERY_BLOCK))
    # the stated query set against all rows, block by block
    own = lambda blocks: F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.sequence(F.lit(0), F.lit(blocks - 1))
    x = distinct.select(F.lit(False).alias("is_query"), "rep", "vec", own(bx).alias("xb"), F.explode(every(bq)).alias("qb"))
    q = distinct.where("asked").select(F.lit(True).alias("is_query"), "rep", "vec", F.explode(every(bx)).alias("xb"), own(bq).alias("qb"))

    def meet(key: tuple, t: pa.Table) -> pa.Table:
        asks = t.column("is_query").to_numpy()
        rep, vec = t.column("rep").to_numpy(), matrix(t.column("vec"), np.int64)
        xs, qs = np.flatnonzero(~asks), np.flatnonzero(asks)
        # one more than asked for: the query's own row may be among them
        out = [(np.full(len(r), rep[qs[i]]), rep[xs[r]], s) for i, r, s in search_block(vec[xs], vec[qs], k + 1)] if len(xs) else []
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("q", "x", "score"), cols, strict=True)})

    found = x.unionByName(q).groupBy("xb", "qb").applyInArrow(meet, "q long, x long, score long")
    return best_of(saved(found, "topk-found"), distinct, queries, k)
