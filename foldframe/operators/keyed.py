"""Keyed statistics re-attached to rows.

The pandas idiom `groupby(key, dropna=False).transform(f)` / `value_counts` + `map`
becomes a grouped aggregate (partial aggregation in the map tasks, only partial
buffers are shuffled) and one lazy null-safe left join per key. How a join runs is
left to Spark: adaptive execution broadcasts a statistic table whose measured
size allows it and splits hot keys of a shuffled one otherwise.

`KeyStatistics` computes the statistics of several keys together: the keys and values
of the rows are written once, stacked to (key name, key value) pairs and aggregated. Every
key's table is a folder of its own in the shared scratch folder, so that a join sees the
size of its table alone: one with few groups is broadcast and the rows stay where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import saved, scratch_path
from .quantiles import grouped_quantiles


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str | tuple[Column, str]], bounded: bool = False) -> DataFrame:
    """Left-join `stats` (key columns + value columns) onto `df`.

    `keys` are column names present in both frames, or `(expr_on_df, name_in_stats)`
    pairs. NULL keys match NULL keys (`<=>`), as pandas groups missing keys.
    `bounded=True` means the caller has a proof of the size of `stats` (a
    label domain, the number of folds): it is broadcast."""
    renamed, on = stats, []
    for i, k in enumerate(keys):
        left, right = (F.col(k), k) if isinstance(k, str) else k
        renamed = renamed.withColumnRenamed(right, f"__key{i}__")
        on.append(left.eqNullSafe(F.col(f"__key{i}__")))
    out = df.join(F.broadcast(renamed) if bounded else renamed, on, "left")
    return out.drop(*[f"__key{i}__" for i in range(len(on))])


class KeyStatistics:
    """Row count, mean, sample deviation and median of value columns by several keys.

    `keys`: name -> key expression; `values`: the columns to average; `medians`:
    (key name, value) pairs that also need the exact median; `counted`: the keys that need
    the row count only, as may have nearly as many groups as there are rows."""

    ALL = "__all__"

    def __init__(self, source: DataFrame, keys: dict[str, Column], values: Sequence[str], medians: Sequence[tuple[str, str]] = (),
                 counted: Sequence[str] = ()):
        place = {n: f"__k{i}" for i, n in enumerate(keys)}
        rows = saved(source.select(*[k.cast("string").alias(place[n]) for n, k in keys.items()],
                                   *[F.col(v).cast("double").alias(v) for v in values]), "key-rows")

        def stacked(names: Sequence[str], columns: Sequence[str]) -> DataFrame:
            return rows.select(F.inline(F.array(*[F.struct(F.lit(n).alias("kname"), F.col(place[n]).alias("kval")) for n in names])), *columns)

        group, count = ["kname", "kval"], F.count(F.lit(1)).cast("double").alias("count")
        self.keys, self.parts = keys, {}
        if counted:
            self.parts |= by_name(stacked(counted, []).groupBy(*group).agg(count), counted)
        if averaged := [n for n in keys if n not in counted]:
            aggs = [x for v in values for x in (F.avg(v).alias(f"{v}_mean"), F.stddev_samp(v).alias(f"{v}_std"))]
            table = stacked(averaged, values).groupBy(*group).agg(count, *aggs)
            if medians:
                names, cols = sorted({n for n, _ in medians}), sorted({v for _, v in medians})
                found = grouped_quantiles(stacked(names, cols), group, cols, [0.5])
                wide = found.groupBy(*group).agg(*[F.max(F.when(F.col("vname") == v, F.col("value"))).alias(f"{v}_median") for v in cols])
                table = attach(table, wide, group)
            self.parts |= by_name(table, averaged)

    def onto(self, df: DataFrame, name: str, columns: dict[str, str]) -> DataFrame:
        """`df` with statistics of the key `name`; `columns`: new column -> statistic."""
        part = self.parts[name].select("kval", *[F.col(s).alias(c) for c, s in columns.items()])
        return attach(df, part, [(self.keys[name].cast("string"), "kval")])


def by_name(table: DataFrame, names: Sequence[str]) -> dict[str, DataFrame]:
    """The rows of each `kname`, from a folder of their own; no folder, no rows."""
    spark, path = table.sparkSession, scratch_path(table.sparkSession, "key-statistics")
    table.write.partitionBy("kname").parquet(path)
    there = {r["kname"] for r in spark.read.schema(table.schema).parquet(path).select("kname").distinct().collect()}
    kind = table.drop("kname").schema
    return {n: spark.read.schema(kind).parquet(f"{path}/kname={n}") if n in there else spark.createDataFrame([], kind) for n in names}
