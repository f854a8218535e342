"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order in which it sees a set of pivots, nearest
first. It is posted in the inverted files of its first few pivots; a query opens
the files of its own first pivots, ranks what it finds by the footrule distance
between the two orders, and computes exact scores for the best of each file.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved
from .vectors import best_of, distinct_vectors, list_column, matrix, takes_part, usual_length


class Settings(NamedTuple):
    """pivots = per_root * sqrt(distinct vectors), at most most_pivots; a vector is posted
    under `posted` pivots, a query opens `opened` files or, if that is more, `opened_share`
    of all; orders are compared over `order` pivots, and the `reranked` best of a file's
    block or, if that is more, `reranked_share` of it are scored exactly. So the share of
    the table that a query sees stays the same at every size, and with it the recall (the
    README has figures). Beyond (most_pivots / per_root)**2 = 256 million vectors files
    grow with the table. Files are worked on in blocks of about `block` vectors by
    `query_block` queries."""
    per_root: float = 2.0
    most_pivots: int = 32_000
    posted: int = 12
    opened: int = 32
    opened_share: float = 0.032
    order: int = 64
    reranked: int = 300
    reranked_share: float = 0.085
    block: int = 4096
    query_block: int = 1024


def choose_pivots(distinct: DataFrame, settings: Settings) -> np.ndarray:
    """Unit pivots: a sample of the distinct vectors by a hash, bounded by most_pivots."""
    n = distinct.count()
    m = int(min(settings.most_pivots, n, np.ceil(settings.per_root * np.sqrt(n)))) if n else 0
    h = F.shiftrightunsigned(F.xxhash64("rep", F.lit(17)), 1)
    # about four times as many as needed are put in order, not as many from every task
    some = distinct.where(h < F.lit(int(2.0 ** 63 * 4.0 * m / n))) if m and n > 8 * m else distinct
    rows = some.orderBy(h, "rep").limit(m).select("vec").collect() if m else []
    p = np.array([r["vec"] for r in rows], dtype=np.float64)
    return p / np.linalg.norm(p, axis=1, keepdims=True) if len(p) else p


def postings(vectors: DataFrame, pivots: np.ndarray, files: int, length: int, is_query: bool) -> DataFrame:
    """(file, is_query, rep, vec, seen): each vector under its first `files` pivots, with
    the first `length` pivots it sees."""
    files, length = min(files, len(pivots)), min(length, len(pivots))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, n = matrix(part.column(1), np.float64), part.num_rows
                near = x @ pivots.T
                seen = np.argsort(-near, axis=1, kind="stable")[:, :length].astype(np.int16)
                take = np.repeat(np.arange(n), files)
                rep = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen[:, :files].reshape(-1).astype(np.int32)), pa.array(np.full(len(take), is_query)), pa.array(rep[take]),
                     list_column(x[take], pa.float64()), list_column(seen[take], pa.int16())], ["file", "is_query", "rep", "vec", "seen"])

    return vectors.select("rep", "vec").mapInArrow(emit, "file int, is_query boolean, rep long, vec array<double>, seen array<smallint>")


def in_blocks(posted: DataFrame, settings: Settings) -> DataFrame:
    """Adds (xb, qb): a file of very many vectors or queries is cut into blocks, and every
    block of vectors meets every block of queries."""
    parts = lambda n, size: F.greatest(F.ceil(n / float(size)), F.lit(1)).cast("int")
    n = posted.groupBy("file").agg(F.count(F.when(~F.col("is_query"), 1)).alias("nx"), F.count(F.when(F.col("is_query"), 1)).alias("nq"))
    # one row per pivot: bounded by most_pivots
    sizes = F.broadcast(n.where("nx > 0 and nq > 0").select(F.col("file").alias("s_file"), parts(F.col("nx"), settings.block).alias("bx"),
                                                            parts(F.col("nq"), settings.query_block).alias("bq")))
    own = lambda blocks: F.pmod(F.xxhash64("rep"), F.col(blocks)).cast("int")
    every = lambda blocks: F.sequence(F.lit(0), F.col(blocks) - 1)
    d = posted.join(sizes, F.col("file") == F.col("s_file"))
    d = d.withColumn("xb", F.explode(F.when(F.col("is_query"), every("bx")).otherwise(F.array(own("bx")))))
    d = d.withColumn("qb", F.explode(F.when(F.col("is_query"), F.array(own("bq"))).otherwise(every("bq"))))
    return d.drop("s_file", "bx", "bq")


def rank_file(file: int, q: np.ndarray, q_seen: np.ndarray, x: np.ndarray, x_seen: np.ndarray, pivots: int, posted: int,
              order: int, reranked: int, keep: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (index): the rows of x that score best and their scores.

    A pair that meets in several files is left to the first one in the query's order."""
    order = min(order, q_seen.shape[1])
    place = np.full((len(x), pivots), order, dtype=np.int16)
    np.put_along_axis(place, x_seen[:, :order].astype(np.int64), np.arange(order, dtype=np.int16)[None, :].repeat(len(x), 0), 1)
    mine = x_seen[:, :posted].astype(np.int64)
    steps = np.arange(order, dtype=np.int16)
    for i in range(len(q)):
        turn = np.full(pivots, np.iinfo(np.int16).max, dtype=np.int16)
        turn[q_seen[i]] = np.arange(q_seen.shape[1], dtype=np.int16)
        rows = np.flatnonzero(turn[mine].min(axis=1) == turn[file])
        if len(rows) > reranked:
            there = place[np.ix_(rows, q_seen[i, :order].astype(np.int64))]
            # footrule over both lists, a pivot outside a list counting as its end; what the
            # row's own list adds beyond the shared pivots is a constant minus the second sum
            footrule = np.abs(there - steps).sum(axis=1, dtype=np.int32) - (order - there).sum(axis=1, dtype=np.int32)
            rows = rows[np.argpartition(footrule, reranked - 1)[:reranked]]
        score = (x[rows] * q[i]).sum(axis=1)
        if len(rows) > keep:
            cut = np.partition(score, len(rows) - keep)[len(rows) - keep]
            rows, score = rows[score >= cut], score[score >= cut]
        yield i, rows, score


def search(distinct: DataFrame, asked: DataFrame, pivots: np.ndarray, s: Settings, k: int) -> DataFrame:
    """(q, x, score) of distinct vectors found for the distinct query vectors."""
    opened = max(s.opened, int(np.ceil(s.opened_share * len(pivots))))
    posted = saved(postings(distinct, pivots, s.posted, max(s.order, s.posted), False)
                   .unionByName(postings(asked, pivots, opened, max(s.order, opened), True)), "ann-postings")
    count = len(pivots)

    def meet(key: tuple, t: pa.Table) -> pa.Table:
        is_q = t.column("is_query").to_numpy()
        # rows in the order of their ids, so that ties fall alike in every run
        tx, tq = t.filter(pa.array(~is_q)).sort_by("rep"), t.filter(pa.array(is_q))
        if not len(tx) or not len(tq):
            return pa.table({"q": pa.array([], pa.int64()), "x": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q_rep, x_rep = tq.column("rep").to_numpy(), tx.column("rep").to_numpy()
        q, q_seen, x, x_seen = (matrix(c.column(n), kind) for c in (tq, tx) for n, kind in (("vec", np.float64), ("seen", np.int16)))
        reranked = max(s.reranked, int(np.ceil(s.reranked_share * len(x_rep))))
        out = [(np.full(len(rows), q_rep[i]), x_rep[rows], score) for i, rows, score in rank_file(
            key[0].as_py(), q, q_seen, x, x_seen, count, s.posted, s.order, reranked, k + 1)]
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"q": pa.array(cols[0], pa.int64()), "x": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    return in_blocks(posted, s).groupBy("file", "xb", "qb").applyInArrow(meet, "q long, x long, score double")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, settings: Settings = Settings(), dim: int | None = None) -> DataFrame:
    """The `k` nearest found of every query row: query_id, rank (from 1), vec_id, score.

    `vectors` needs vec_id and embedding; other columns are ignored. Nearness is the
    largest inner product in double precision, equal ones by the smaller vec_id;
    candidates are all rows but the query's own. Vectors that are null, zero, hold null
    or non-finite components or differ in length from `dim` (default: the most frequent
    length) take no part. Equal vectors are indexed once, with their k + 1 smallest ids.
    A query whose files held fewer than `k` candidates is compared with all rows. Rows
    with a null vec_id take no part; rows of one vec_id are
    separate candidates, equal ones one query, and a query leaves out all of its own id. An empty table gives an empty result. All rows are indexed; the pivots are a bounded
    sample (Settings)."""
    dim = dim or usual_length(vectors, "embedding")
    rows = saved(vectors.where(takes_part(F.col("embedding"), dim, True) & F.col("vec_id").isNotNull())
                 .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: v.cast("double") + 0.0).alias("vec"),
                         F.coalesce(is_query, F.lit(False)).alias("is_query")), "ann-rows")
    distinct, queries = distinct_vectors(rows, k + 1)
    pivots = choose_pivots(distinct, settings)
    if not len(pivots):
        return queries.select("query_id", F.lit(1).alias("rank"), F.col("rep").alias("vec_id"), F.lit(0.0).alias("score")).where("false")
    found = saved(search(distinct, distinct.where("asked"), pivots, settings, k), "ann-found")
    # few files may hold fewer rows than asked for: these queries open all files
    enough = found.groupBy("q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > k).select("q")
    short = saved(distinct.where("asked").join(enough, F.col("rep") == F.col("q"), "left_anti"), "ann-short")
    if not short.isEmpty():
        everything = settings._replace(posted=1, opened=len(pivots), reranked=1 << 30)
        again = search(distinct, short, pivots, everything, k)
        found = found.join(short.select(F.col("rep").alias("s_rep")), F.col("q") == F.col("s_rep"), "left_anti").unionByName(again)
    return best_of(found, distinct, queries, k)
