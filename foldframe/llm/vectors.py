"""Vectors as rows: which take part, and equal ones put together."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.ranking import global_rank
from ..session import saved


def takes_part(vector: Column, dim: int, nonzero: bool) -> Column:
    """A vector of `dim` finite components, none of them null; `nonzero`: not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = vector.isNotNull() & (F.size(vector) == dim) & F.coalesce(finite, F.lit(False))
    return ok & F.exists(vector, lambda x: x != 0) if nonzero else ok


def usual_length(df: DataFrame, vector: str) -> int:
    """The most frequent length of a vector; the longer one of equally frequent ones."""
    row = (df.where(F.size(vector) > 0).groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.desc("d")).first())
    return int(row["d"]) if row else 0


def distinct_vectors(rows: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """For `rows` (vec_id, vec, is_query): the distinct vectors, (rep, vec, ids, asked)
    with the `keep` smallest ids of each, and the queries, (query_id, rep), equal ones
    once. `rep` is a key in the order of the smallest ids: that id itself, or its rank
    where different vectors have one id.

    A nearest list of fewer than `keep` entries never needs more of equal vectors,
    whose scores tie. The limit on ids acts in the map tasks, so a vector that very
    many rows hold is not gathered anywhere."""
    first = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = rows.select("vec", "vec_id").withColumn("_n", first).where(F.col("_n") <= keep)
    ids = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where("is_query").select(F.col("vec").alias("q_vec")).distinct().withColumn("asked", F.lit(True))
    distinct = saved(ids.join(asked, F.col("vec") == F.col("q_vec"), "left")
                     .select(F.col("ids")[0].alias("rep"), "vec", "ids", F.coalesce("asked", F.lit(False)).alias("asked")), "vectors")
    if not distinct.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        distinct = saved(global_rank(distinct, ["rep", F.xxhash64("vec"), "vec"], "place").select(F.col("place").alias("rep"), "vec", "ids", "asked"), "vectors")
    who = rows.where("is_query").select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q_vec")).distinct()
    queries = who.join(distinct.where("asked").select("rep", "vec").hint("shuffle_merge"), F.col("q_vec") == F.col("vec")).select("query_id", "rep")
    return distinct, saved(queries, "vector-queries")


def matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def list_column(a: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    n, width = a.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(a).reshape(-1), kind))


def best_of(found: DataFrame, distinct: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` best rows of each query from the pairs of
    distinct vectors in `found` (q, x, score), equal scores by vec_id, without its own row."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "x")
    top = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1).select("q", "x", "score")
    ids = distinct.select(F.col("rep").alias("i_rep"), "ids")
    rows = saved(top.join(ids.hint("shuffle_merge"), F.col("x") == F.col("i_rep"))
                 .groupBy("q").agg(F.collect_list(F.struct("score", "ids")).alias("hits")), "nearest")
    # at most (k + 1) ** 2 rows for a distinct query vector
    each = queries.join(rows.hint("shuffle_merge"), F.col("rep") == F.col("q")).select(
        "query_id", "rep", F.explode("hits").alias("h")).select("query_id", "rep", F.col("h.score").alias("score"), F.explode("h.ids").alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id", "rep").orderBy(F.desc("score"), "vec_id"))
    return (each.where(F.col("vec_id") != F.col("query_id")).withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
