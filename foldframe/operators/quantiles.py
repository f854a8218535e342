"""Exact quantiles, per group or over a whole table, without gathering a group.

A mergeable sketch first gives, for each group, two values that are sure to
enclose the wanted position. Only rows between the two are then counted by value
and put in order; all rows below are one count. The band holds a few parts in
ten thousand of a group, so neither a hot group nor a whole table ever meets in
one task, and equal values collapse to one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved

# the sketch's rank error is a part in ACCURACY; the band is that much wider on both sides
ACCURACY = 10_000


def grouped_quantiles(df: DataFrame, keys: Sequence[str], values: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(keys..., vname, prob, value): the quantile of every column in `values` within
    every group, linearly interpolated at position prob * (n - 1). Null and NaN values
    are left out, a null key is a group, groups without values are absent.

    The bands are written before rows meet them, so that their size decides the join: rows
    stay where they are beside few groups. The join is a left one, whose rows are never the
    side that is broadcast; every row has its group. A row is counted once, however many
    probabilities are asked for."""
    if not values or not probs:
        raise ValueError("quantiles need at least one column and one probability")
    keys, near, probs = list(keys), 2.0 / ACCURACY, sorted({float(p) for p in probs})
    pairs = F.array(*[F.struct(F.lit(c).alias("vname"), F.col(c).cast("double").alias("v")) for c in values])
    rows = df.select(*keys, F.inline(pairs)).where(F.col("v").isNotNull() & ~F.isnan("v"))
    ends = [min(max(p + side * near, 0.0), 1.0) for p in probs for side in (-1, 1)]
    group = [*keys, "vname"]
    bands = saved(rows.groupBy(*group).agg(F.percentile_approx("v", ends, ACCURACY).alias("ends"), F.count("v").alias("n")), "quantile-bands")
    known = bands.select(*[F.col(g).alias(f"b_{g}") for g in group], "ends", "n")
    on = [F.col(g).eqNullSafe(F.col(f"b_{g}")) for g in group]
    low, high = (lambda i: F.col("ends")[2 * i]), (lambda i: F.col("ends")[2 * i + 1])

    def band(first: int, last: int) -> Column:
        """Start of the first of these bands that does not end below the row, by bisection."""
        if first == last:
            return low(first)
        middle = (first + last) // 2
        return F.when(F.col("v") <= high(middle), band(first, middle)).otherwise(band(middle + 1, last))

    # a row between two bands counts at the next one's start, before the rows inside; one above all not at all
    placed = (rows.join(known, on, "left").where(F.col("v") <= high(len(probs) - 1))
              .select(*group, "n", "v", band(0, len(probs) - 1).alias("start")))
    counted = (placed.groupBy(*group, "n", F.greatest("v", "start").alias("at"), (F.col("v") >= F.col("start")).alias("inside"))
               .agg(F.count(F.lit(1)).alias("c")))
    w = Window.partitionBy(*group).orderBy("at", "inside")
    upto = counted.withColumn("upto", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("inside")
    where = lambda p: p * (F.col("n") - 1)
    holds = lambda k: (F.col("upto") > k) & (F.col("upto") - F.col("c") <= k)
    hits = F.filter(F.array(*[F.lit(p) for p in probs]), lambda p: holds(F.floor(where(p))) | holds(F.ceil(where(p))))
    each = upto.select(*group, "n", "at", "upto", "c", F.explode(hits).alias("prob"))
    place = where(F.col("prob"))
    found = each.groupBy(*group, "prob", "n").agg(F.max(F.when(holds(F.floor(place)), F.col("at"))).alias("lo"), F.max(F.when(holds(F.ceil(place)), F.col("at"))).alias("hi"))
    return found.select(*group, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * (place - F.floor(place))).alias("value"))


def whole_quantiles(df: DataFrame, values: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float | None]:
    """Quantiles over the whole table as a dict by (column, probability); None for a
    column without values. One row per column and probability comes to the driver."""
    found = {(r["vname"], r["prob"]): r["value"] for r in grouped_quantiles(df, [], values, probs).collect()}
    return {(c, p): found.get((c, float(p))) for c in values for p in probs}
