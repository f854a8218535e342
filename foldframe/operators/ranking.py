"""Exact global ranks without a single-partition window (R3), and the
equal-count price bins built on them (D7).

`row_number() OVER (ORDER BY x)` moves every row into one task. Here the rows
are range-partitioned on the full (unique) ordering key, so even a value that
holds a third of all rows is spread over many partitions (the id breaks the
tie); each partition is sorted locally, numbered with
`monotonically_increasing_id`, and shifted by the running total of the
partition sizes (a table with one row per partition, broadcast by proof of
its size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_EXECUTION
from ..session import saved

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row in partition


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    if DEFAULT_EXECUTION.rank_partitions:
        return DEFAULT_EXECUTION.rank_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based rank in the order of `order`, which must be unique per row
    (end it with the id column)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = _partitions(df, num_partitions)
    # written once: the row numbers must not be made again with other partitions
    tagged = saved(df.repartitionByRange(parts, *cols).sortWithinPartitions(*cols)
                   .withColumn("__pid", F.spark_partition_id()).withColumn("__mid", F.monotonically_increasing_id()), "ranked")
    sizes = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: the running total is a window over a tiny table
    offsets = sizes.select(
        "__pid",
        F.coalesce(F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), _ROW_BITS)
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(rank_col, (F.col("__off") + local + 1).cast("long"))
            .drop("__pid", "__mid", "__off"))


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], rank_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """1-based rank inside each group, computed as a global rank over
    (group, order) minus the group's start offset. `group` must have a
    bounded number of distinct values (labels, repeats): the offset table is
    broadcast."""
    ranked = global_rank(df, [*group, *order], "__grank", num_partitions)
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__gn"))
    w = Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, F.coalesce(F.sum("__gn").over(w), F.lit(0)).alias("__gstart"))
    out = ranked.join(F.broadcast(starts.withColumnsRenamed({g: f"__s_{g}" for g in group})),
                      [ranked[g].eqNullSafe(F.col(f"__s_{g}")) for g in group])
    return (out.withColumn(rank_col, F.col("__grank") - F.col("__gstart"))
            .drop("__grank", "__gstart", *[f"__s_{g}" for g in group]))


def price_quantile_bin(df: DataFrame, price_col: str, id_col: str, bucket_count: int = 5,
                       out_col: str = "price_bin") -> DataFrame:
    """Rank by (price, id) ("first" ties), equal-count cut of the ranks into
    Q1..Qk (pandas qcut on ranks: bucket = max(ceil((r-1)k/(n-1)) - 1, 0));
    missing price -> `__PRICE_MISSING__`."""
    if bucket_count < 2:
        raise ValueError(f"{bucket_count} buckets: ranks are cut into 2 or more")
    present = df.where(F.col(price_col).isNotNull())
    n = present.count()
    missing = df.where(F.col(price_col).isNull()).withColumn(out_col, F.lit(C.PRICE_MISSING))
    if n == 0:
        return missing
    ranked = global_rank(present, [F.col(price_col), F.col(id_col)], "__prank")
    a = (F.col("__prank") - 1) * F.lit(bucket_count)
    b = F.lit(max(n - 1, 1))
    bucket = F.greatest(F.ceil(a / b) - 1, F.lit(0)) if n > 1 else F.lit(0)
    labelled = ranked.withColumn(out_col, F.concat(F.lit("Q"), (bucket + 1).cast("string"))).drop("__prank")
    return labelled.unionByName(missing)
