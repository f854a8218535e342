"""Residual calibration of out-of-fold predictions, and where it pays.

Rows fall into cells: the prediction's bucket, that with the age bin, that with the
power bin as well. A cell's correction is the median residual (additive) or the median
quotient of target and prediction (ratio) of its rows, shrunk toward the correction of the
cell above it. The correction that a row gets is fitted without the row's own fold: all
"without fold g" tables come from one pass, in which a row counts for every fold but its
own, and a cell keeps them as a small map of one entry per fold (0: all rows, for tables
without targets).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, exp, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import edges_below
from ..functions.dates import age_bin, power_bin
from ..session import saved
from . import keyed
from .quantiles import whole_quantiles

ALL_ROWS = 0
CELLS = ("cell1", "cell2", "cell3")


def bucket_edges(df: DataFrame, pred: str, buckets: int) -> list[float]:
    """Inner edges of equal-count buckets of the predictions, ascending and distinct; the
    targets have no part in them."""
    if buckets < 2:
        raise ValueError(f"{buckets} buckets: a calibration needs 2 or more")
    found = whole_quantiles(df, [pred], [k / buckets for k in range(1, buckets)])
    return sorted({v for v in found.values() if v is not None})


def bucket_of(value: Column, edges: Sequence[float]) -> Column:
    """`b0`, `b1`, ...: the number of edges below the value; missing -> `__PRED_MISSING__`."""
    below = reduce(lambda a, e: a + (value > F.lit(e)).cast("int"), edges, F.lit(0))
    return F.when(value.isNull() | F.isnan(value), F.lit("__PRED_MISSING__")).otherwise(F.concat(F.lit("b"), below.cast("string")))


def cells(pred: Column, edges: Sequence[float], age_col: str = "car_age_years", power_col: str = "power") -> dict[str, Column]:
    """The keys of a row's cells, each finer than the one before."""
    b, a, p = bucket_of(pred, edges), age_bin(age_col), power_bin(power_col)
    return {"cell1": b, "cell2": F.concat_ws("|", b, a), "cell3": F.concat_ws("|", b, a, p)}


@dataclass
class Calibration:
    """Fitted corrections. `tables` holds for each cell level (key, maps): the correction by
    left-out fold; `overall` the same over all cells."""

    kind: str
    edges: list[float]
    tables: dict[str, DataFrame]
    overall: dict[int, float]

    def apply(self, df: DataFrame, pred: str, fold: Column | None = None, age_col: str = "car_age_years",
              power_col: str = "power", out: str = "calibrated") -> DataFrame:
        """`df` with `correction` and `out`. `fold` is the fold that must not count for a
        row: its own one, or None for rows that had no part in the fit. A row takes the
        finest of its cells that has rows in the other folds."""
        g = F.lit(ALL_ROWS) if fold is None else fold.cast("int")
        pairs = [F.lit(x).cast(t) for k, v in self.overall.items() for x, t in ((k, "int"), (v, "double"))]
        found = F.try_element_at(F.create_map(*pairs), g)
        keys = cells(F.col(pred), self.edges, age_col, power_col)
        for level in CELLS:
            table = self.tables[level].select(F.col("key").alias("__cell"), F.col("by_fold").alias(f"__{level}"))
            df = keyed.attach(df, table, [(keys[level], "__cell")])
            found = F.coalesce(F.try_element_at(F.col(f"__{level}"), g), found)
        p = F.col(pred)
        new = p + found if self.kind == "additive" else p * found
        df = df.withColumn("correction", found).withColumn(out, F.when(new < 0, F.lit(0.0)).otherwise(new))
        return df.drop(*[f"__{level}" for level in CELLS])


# classes of values by which a median's neighbourhood is found
VALUE_CLASSES = 128


def _medians_without(rows: DataFrame) -> DataFrame:
    """(level, key, g, m, n): median and number of the values v in each cell without fold g
    (ALL_ROWS: with all of them), exactly; `rows` have fold, v and CELLS.

    Rows are counted once by cell, fold and class of value; these counts, bounded by the
    label domains, tell for every cell and fold the class that holds the median. Only rows
    of such a class are put in order: a few in a hundred of the table."""
    cuts = rows.where(~F.isnan("v")).agg(F.percentile_approx("v", [k / VALUE_CLASSES for k in range(1, VALUE_CLASSES)], 10_000)).first()[0]
    rows = saved(rows.withColumn("class", F.when(~F.isnan("v"), edges_below("v", sorted(set(cuts or []))))), "residual-rows")
    # one row per fold comes to the driver
    folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect())
    out_of = F.filter(F.array(*[F.lit(g) for g in [ALL_ROWS, *folds]]), lambda g: g != F.col("fold"))
    levels = F.array(*[F.struct(F.lit(i + 1).alias("level"), F.col(c).alias("key")) for i, c in enumerate(CELLS)], F.struct(F.lit(0).alias("level"), F.lit("").alias("key")))
    cell = ["level", "key", "g"]
    counts = saved(rows.groupBy(*CELLS, "fold", "class").agg(F.count(F.lit(1)).alias("c")), "residual-counts")
    each = counts.select("class", "c", F.explode(out_of).alias("g"), levels.alias("levels")).select("class", "c", "g", F.inline("levels"))
    each = each.groupBy(*cell, "class").agg(F.sum("c").alias("c"))
    whole, real = Window.partitionBy(*cell), F.when(F.col("class").isNotNull(), F.col("c")).otherwise(F.lit(0))
    upto = F.sum(real).over(whole.orderBy("class").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    each = each.withColumns({"n": F.sum("c").over(whole), "reals": F.sum(real).over(whole), "upto": upto}).where(F.col("class").isNotNull())
    middle = 0.5 * (F.col("reals") - 1)
    holds = lambda k: (F.col("upto") > k) & (F.col("upto") - F.col("c") <= k)
    want = saved(each.groupBy(*cell, "n", "reals").agg(
        F.max(F.when(holds(F.floor(middle)), F.col("class"))).alias("first"), F.max(F.when(holds(F.ceil(middle)), F.col("class"))).alias("last"),
        F.max(F.when(holds(F.floor(middle)), F.col("upto") - F.col("c"))).alias("before")), "residual-classes")
    wanted = want.groupBy("level", "key").agg(F.collect_list(F.struct("g", "first", "last")).alias("wanted"))
    stacked = rows.select("v", "fold", "class", F.inline(levels)).where(F.col("class").isNotNull())
    near = F.filter("wanted", lambda x: (x["g"] != F.col("fold")) & ((x["first"] == F.col("class")) | (x["last"] == F.col("class"))))
    found = keyed.attach(stacked, wanted, ["level", "key"]).select("level", "key", "v", F.inline(near)).groupBy(*cell, "v").agg(F.count(F.lit(1)).alias("c"))
    found = keyed.attach(found, want, cell)
    found = found.withColumn("upto", F.col("before") + F.sum("c").over(whole.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ends = found.groupBy(*cell, "n", "reals").agg(F.max(F.when(holds(F.floor(middle)), F.col("v"))).alias("lo"), F.max(F.when(holds(F.ceil(middle)), F.col("v"))).alias("hi"))
    return ends.select(*cell, (F.col("lo") + (F.col("hi") - F.col("lo")) * (middle - F.floor(middle))).alias("m"), "n")


def fit_calibration(oof: DataFrame, pred: str, kind: str = "additive", target_col: str = C.TARGET_COL, fold_col: str = "fold", buckets: int = 10,
                    shrink: float = 50.0, age_col: str = "car_age_years", power_col: str = "power") -> Calibration:
    """Corrections from an OOF table, cross-fitted by `fold_col` (numbers from 1).

    `kind`: additive, the median of target - prediction, or ratio, the median of target /
    prediction over positive predictions. A cell of n rows counts n, the cell above it
    `shrink` rows. Rows without target or prediction have no part."""
    if kind not in ("additive", "ratio"):
        raise ValueError(f"a calibration is additive or ratio, not {kind}")
    if shrink < 0:
        raise ValueError(f"shrink is {shrink}; it counts rows, 0 or more")
    edges = bucket_edges(oof, pred, buckets)
    y, p = F.col(target_col).cast("double"), F.col(pred).cast("double")
    value = y - p if kind == "additive" else F.when(p > 0, y / p)
    keys = cells(F.col(pred), edges, age_col, power_col)
    rows = oof.select(F.col(fold_col).cast("int").alias("fold"), value.alias("v"), *[k.alias(c) for c, k in keys.items()]).where("v is not null")
    known = saved(_medians_without(rows), "residual-cells")

    # label domains times folds: a bounded number of rows from here on
    above = known.where("level = 0").select("g", F.col("m").alias("up"))
    overall = {r["g"]: r["up"] for r in above.collect()}
    tables, parent = {}, None
    for i, level in enumerate(CELLS, 1):
        own = known.where(F.col("level") == i).select("key", "g", "m", "n")
        if parent is None:
            both = own.join(above, "g")
        else:
            up = parent.select(F.col("key").alias("up_key"), F.col("g").alias("up_g"), F.col("c").alias("up"))
            both = own.join(up, (F.substring_index("key", "|", i - 1) == F.col("up_key")) & (F.col("g") == F.col("up_g")))
        weight = F.col("n") + F.lit(float(shrink))
        parent = saved(both.select("key", "g", ((F.col("n") * F.col("m") + F.lit(float(shrink)) * F.col("up")) / weight).alias("c")), "residual-level")
        maps = parent.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("g", "c"))).alias("by_fold"))
        tables[level] = saved(maps, "residual-maps")
    return Calibration(kind, edges, tables, overall)


def calibrate(oof: DataFrame, pred: str, kind: str = "additive", fold_col: str = "fold", target_col: str = C.TARGET_COL, **how) -> DataFrame:
    """An OOF table with `correction` and `calibrated`, each row corrected by the residuals
    of the other folds alone."""
    return fit_calibration(oof, pred, kind, target_col, fold_col, **how).apply(oof, pred, F.col(fold_col))


# --------------------------------------------------------------- error slices
# upper edges of the error sketch; counts below them merge by addition
ERROR_EDGES = (50.0, 100.0, 200.0, 500.0, 1000.0, 2000.0, 5000.0, 10_000.0, 20_000.0, 50_000.0, 100_000.0)
SLICES = ((), ("age_bin",), ("power_bin",), ("price_band",), ("brand",), ("age_bin", "power_bin"), ("brand", "age_bin"), ("price_band", "age_bin"))


def error_slices(df: DataFrame, pred: str, target_col: str = C.TARGET_COL, price_edges: Sequence[float] = (1000.0, 5000.0, 20_000.0, 100_000.0),
                 slices: Sequence[Sequence[str]] = SLICES, age_col: str = "car_age_years", power_col: str = "power") -> DataFrame:
    """Errors by slices of age, power, price and brand, in one aggregate over grouping sets.

    Returns slice (the names of its keys), age_bin, power_bin, price_band, brand (`*`
    where the slice does not tell them apart), n, bias (mean of prediction - target), mae,
    rmse, share (of all absolute error), within (counts up to each of ERROR_EDGES) and
    p50_below, p90_below: the first edge that half, or nine tenths, of the errors do not
    exceed (null beyond the last). The sketch holds the same few counts whatever a
    slice's size, so hot slices are added up in the map tasks."""
    e = F.col(pred).cast("double") - F.col(target_col).cast("double")
    keys = {"age_bin": age_bin(age_col), "power_bin": power_bin(power_col), "price_band": bucket_of(F.col(target_col), price_edges),
            "brand": F.coalesce(F.col("brand").cast("string"), F.lit(C.MISSING_CATEGORY))}
    rows = df.select(*[k.alias(c) for c, k in keys.items()], e.alias("e")).where("e is not null")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("e").alias("se"), F.sum(F.abs("e")).alias("sa"), F.sum(F.col("e") * F.col("e")).alias("sq"),
            *[F.count(F.when(F.abs("e") <= x, 1)).alias(f"c{i}") for i, x in enumerate(ERROR_EDGES)]]
    # bit i of the grouping id, from the left, is set where key i is not told apart
    gid = F.grouping_id().alias("gid")
    per = rows.groupingSets([[F.col(c) for c in s] for s in slices], *[F.col(c) for c in keys]).agg(gid, *sums)
    told = {c: F.col("gid").bitwiseAND(F.lit(1 << (len(keys) - 1 - i))) == 0 for i, c in enumerate(keys)}
    whole = F.max(F.when(F.col("gid") == (1 << len(keys)) - 1, F.col("sa"))).over(Window.partitionBy())  # a row per slice, bounded by the label domains
    edge = lambda share: F.element_at(F.filter(F.array(*[F.when(F.col(f"c{i}") >= share * F.col("n"), F.lit(x)) for i, x in enumerate(ERROR_EDGES)]), lambda v: v.isNotNull()), 1)
    first = lambda share: F.when(F.col(f"c{len(ERROR_EDGES) - 1}") >= share * F.col("n"), edge(share))
    return per.select(F.concat_ws("|", *[F.when(t, F.lit(c)) for c, t in told.items()]).alias("slice"),
                      *[F.when(t, F.col(c)).otherwise(F.lit("*")).alias(c) for c, t in told.items()], "n",
                      (F.col("se") / F.col("n")).alias("bias"), (F.col("sa") / F.col("n")).alias("mae"), F.sqrt(F.col("sq") / F.col("n")).alias("rmse"),
                      F.try_divide(F.col("sa"), whole).alias("share"), F.array(*[F.col(f"c{i}") for i in range(len(ERROR_EDGES))]).alias("within"),
                      first(0.5).alias("p50_below"), first(0.9).alias("p90_below"))


# ------------------------------------------------------------- selective uplift
def uplift_choices(calibrated: DataFrame, pred: str, cell: Column, new: str = "calibrated", fold_col: str = "fold", target_col: str = C.TARGET_COL,
                   margin: float = 0.0) -> DataFrame:
    """(fold, cell): where the calibrated prediction is used for the rows of a fold.

    A cell's gain is the absolute error that the calibration takes off on the other
    folds, total minus the fold's own part; `margin` is what it must take off per row to
    count. Cells are put in order by gain per row, and the prefix with the greatest running gain
    is chosen (the shorter one of equally good ones; none, if no prefix gains)."""
    y = F.col(target_col).cast("double")
    gain = F.abs(y - F.col(pred)) - F.abs(y - F.col(new))
    part = calibrated.select(F.col(fold_col).cast("int").alias("fold"), cell.alias("cell"), gain.alias("gain")).where("gain is not null")
    # cells times folds: bounded by the label domains
    part = saved(part.groupBy("fold", "cell").agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("n")), "uplift-cells")
    total = part.groupBy("cell").agg(F.sum("gain").alias("all_gain"), F.sum("n").alias("all_n"))
    folds = sorted(r["fold"] for r in part.select("fold").distinct().collect())
    every = total.withColumn("fold", F.explode(F.array(*[F.lit(g) for g in folds]).cast("array<int>")))
    other = every.join(part, ["fold", "cell"], "left").select("fold", "cell", (F.col("all_gain") - F.coalesce("gain", F.lit(0.0))).alias("gain"), (F.col("all_n") - F.coalesce("n", F.lit(0))).alias("n")).where("n > 0")
    other = other.withColumn("net", F.col("gain") - F.lit(float(margin)) * F.col("n"))
    order = Window.partitionBy("fold").orderBy(F.desc(F.col("net") / F.col("n")), "cell")
    running = other.withColumn("running", F.sum("net").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("place", F.row_number().over(order))
    best = running.groupBy("fold").agg(F.max(F.struct("running", (-F.col("place")).alias("back"))).alias("b")).where("b.running > 0")
    best = best.select(F.col("fold").alias("b_fold"), (-F.col("b.back")).alias("last"))
    return running.join(F.broadcast(best), F.col("fold") == F.col("b_fold")).where("place <= last").select("fold", "cell")


def selective_uplift(oof: DataFrame, pred: str, kind: str = "additive", fold_col: str = "fold", target_col: str = C.TARGET_COL, margin: float = 0.0,
                     level: str = "cell2", **how) -> DataFrame:
    """An OOF table with `correction`, `calibrated`, `chosen` and `uplifted`: the calibrated
    prediction in the cells chosen by their gain on the other folds, else the old one."""
    fitted = fit_calibration(oof, pred, kind, target_col, fold_col, **how)
    ages = {k: v for k, v in how.items() if k in ("age_col", "power_col")}
    table = saved(fitted.apply(oof, pred, F.col(fold_col), **ages), "uplift-rows")
    cell = cells(F.col(pred), fitted.edges, **ages)[level]
    choice = saved(uplift_choices(table, pred, cell, "calibrated", fold_col, target_col, margin), "uplift-choices")
    marked = keyed.attach(table, choice.withColumn("__chosen", F.lit(True)), [(F.col(fold_col).cast("int"), "fold"), (cell, "cell")])
    chosen = F.coalesce("__chosen", F.lit(False))
    return marked.withColumn("chosen", chosen).withColumn("uplifted", F.when(chosen, F.col("calibrated")).otherwise(F.col(pred))).drop("__chosen")


# ------------------------------------------------------------------ promotion
# P(N <= k) of a Poisson number of mean 1, k = 0, 1, ...
def _poisson_steps(most: int = 9) -> list[float]:
    p, out = 0.0, []
    for k in range(most):
        p += exp(-1.0) / factorial(k)
        out.append(round(p, 12))
    return out


def _weight_of(digits: Column) -> Column:
    """Poisson(1) number of eight hexadecimal digits, read as a share u of 16**8: how many of
    the steps u reaches. Digits of one length compare as their numbers do; without any, 0."""
    least = [f"{ceil(x * 2.0 ** 32):08x}" for x in _poisson_steps() if ceil(x * 2.0 ** 32) < 2 ** 32]
    # most numbers are small, so the steps are asked for from the first one on
    first = F.when(digits.isNull() | (digits < F.lit(least[0])), F.lit(0))
    return reduce(lambda a, k: a.when(digits < F.lit(least[k]), F.lit(k)), range(1, len(least)), first).otherwise(F.lit(len(least)))


def with_blocks(rows: DataFrame, id_col: str, replicates: int, seed: int) -> DataFrame:
    """`rows` once for each block of four bootstrap replicates, with `block` and their Poisson(1)
    weights `w0` to `w3`: from the md5 of `id:seed:block`, whose 32 digits make four
    replicates. Block -1 is the table itself, of weight 1 in `w0`."""
    d = rows.withColumn("block", F.explode(F.sequence(F.lit(-1), F.lit(-(-replicates // 4) - 1))))
    d = d.withColumn("_h", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}:"), F.col("block").cast("string"))))
    weight = lambda j: F.when(F.col("block") < 0, F.lit(int(j == 0))).otherwise(_weight_of(F.substring("_h", 8 * j + 1, 8)))
    return d.select(*rows.columns, "block", *[weight(j).alias(f"w{j}") for j in range(4)])


def _by_replicate(blocks: DataFrame, replicates: int, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """`keep`, `replicate` and `columns` of the four replicates (0: the table itself) that
    each row of `blocks` holds as `columns` with the numbers 0 to 3."""
    number = lambda j: F.when(F.col("block") < 0, F.lit(0)).otherwise(F.col("block") * 4 + j + 1)
    each = F.array(*[F.struct(number(j).alias("replicate"), *[F.col(f"{c}{j}").alias(c) for c in columns]) for j in range(4)])
    return blocks.select(*keep, F.inline(each)).where(F.col("replicate") <= replicates)


def with_replicates(rows: DataFrame, id_col: str, replicates: int, seed: int) -> DataFrame:
    """`rows` once for each bootstrap replicate, with `replicate` (from 1) and its weight `w`."""
    return _by_replicate(with_blocks(rows, id_col, replicates, seed), replicates, rows.columns, ["w"]).where("replicate > 0")


def promotion_replicates(pairs: DataFrame, old: str, new: str, id_col: str = C.ID_COL, target_col: str = C.TARGET_COL, replicates: int = 100, seed: int = 42) -> DataFrame:
    """(replicate, n, gain): the mean absolute error that `new` takes off, in every
    bootstrap replicate; replicate 0 is the table itself. A row's weights come from its id,
    so both predictions are resampled alike. Rows are summed by blocks of four replicates."""
    gain = F.abs(F.col(target_col) - F.col(old)) - F.abs(F.col(target_col) - F.col(new))
    rows = pairs.select(id_col, gain.alias("g")).where("g is not null")
    drawn = lambda j: F.sum(F.when(F.col(f"w{j}") > 0, F.col(f"w{j}") * F.col("g")))
    sums = with_blocks(rows, id_col, replicates, seed).groupBy("block").agg(*[x for j in range(4) for x in (F.sum(f"w{j}").alias(f"n{j}"), drawn(j).alias(f"s{j}"))])
    each = _by_replicate(sums, replicates, [], ["n", "s"]).where("n > 0")
    return each.select("replicate", "n", (F.col("s") / F.col("n")).alias("gain"))


def promote_model(pairs: DataFrame, old: str, new: str, share: float = 0.95, least_gain: float = 0.0, **how) -> DataFrame:
    """Whether `new` may replace `old`: one row (rows, gain, low, high, better, promote).

    `low` and `high` are the replicates' 2.5 and 97.5 % quantiles, `better` the share of
    replicates that gain; `promote` asks for at least `share` of them and a gain above
    `least_gain` on the table itself."""
    if not 0 < share <= 1:
        raise ValueError(f"share is {share}; it is a part of the replicates, above 0 up to 1")
    each = promotion_replicates(pairs, old, new, **how)
    drawn, real = F.col("replicate") > 0, F.col("replicate") == 0
    one = each.agg(F.max(F.when(real, F.col("n"))).alias("rows"), F.max(F.when(real, F.col("gain"))).alias("gain"),
                   F.percentile(F.when(drawn, F.col("gain")), 0.025).alias("low"), F.percentile(F.when(drawn, F.col("gain")), 0.975).alias("high"),
                   F.avg(F.when(drawn, (F.col("gain") > 0).cast("double"))).alias("better"))
    return one.withColumn("promote", (F.col("better") >= share) & (F.col("gain") > least_gain))
