"""Sampling, splits and fold assignment (K1-K7).

Folds are an assignment table (id, repeat, fold) instead of index arrays:
"train of fold f" is `fold <> f`. Row order comes from md5(id:seed), so a
fold plan is deterministic in (id, seed), independent of partitioning, and
the same in DuckDB. Per label, rows are dealt round-robin to folds, so fold
sizes differ by at most one per label and each row is validated once per
repeat.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import age_bin as age_bin_expr
from ..functions.dates import frequency_bin
from ..session import saved
from . import keyed
from .ranking import price_quantile_bin


def hash_order(id_col: str, seed: int | Column) -> Column:
    """md5 of `id:seed` as text (ties broken by the id itself)."""
    s = F.lit(str(seed)) if isinstance(seed, int) else seed.cast("string")
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"), s))


# rows that are put in order to find one place among them, and digits that a step tells apart
MARGIN, DIGITS = 100_000, 3


def nth_in_hash_order(ids: DataFrame, n: int, seed: int, id_col: str) -> tuple[str, object] | None:
    """(hash, id) of the n-th row in hash order, None if there are fewer rows.

    Rows are counted by the leading digits of their hashes (16**DIGITS counts), which
    tells the digits of the n-th; again below these until few rows are left, and only those are
    put in order. No row is moved for it."""
    d = ids.select(hash_order(id_col, seed).alias("h"), F.col(id_col).alias("i"))
    known, before = "", 0
    while True:
        step = F.substring("h", 1, len(known) + DIGITS)
        counts = sorted((r["p"], r["n"]) for r in d.where(F.col("h").startswith(known)).groupBy(step.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        for prefix, size in counts:
            if before + size >= n:
                break
            before += size
        else:
            return None
        known = prefix
        if size <= MARGIN or len(known) >= 30:
            break
    row = d.where(F.col("h").startswith(known)).orderBy("h", "i").limit(n - before).agg(F.max(F.struct("h", "i")).alias("last")).first()["last"]
    return row["h"], row["i"]


def _up_to(place: tuple[str, object] | None, seed: int, id_col: str) -> Column:
    """Whether a row comes up to `place` in hash order (None: all do)."""
    if place is None:
        return F.lit(True)
    h = hash_order(id_col, seed)
    return (h < F.lit(place[0])) | ((h == F.lit(place[0])) & (F.col(id_col) <= F.lit(place[1])))


def sample_rows(df: DataFrame, n: int | None, seed: int = 42, id_col: str = C.ID_COL) -> DataFrame:
    """K1: exactly n rows without replacement (None or n >= rows -> all): a filter by the
    hash of the n-th row; rows are neither sorted nor written."""
    if n is None:
        return df
    if n < 1:
        raise ValueError(f"a sample of {n} rows: 1 or more are needed")
    return df.where(_up_to(nth_in_hash_order(df, n, seed, id_col), seed, id_col))


def train_valid_split(df: DataFrame, valid_size: float | int = 0.2, seed: int = 42, shuffle: bool = True,
                      id_col: str = C.ID_COL, split_col: str = "split") -> DataFrame:
    """K2: label rows 'train' / 'valid'. A float is a fraction (ceil), an int
    a row count. Shuffled: the first rows in hash order are validation;
    unshuffled: the last rows in id order."""
    n = df.count()
    if n < 2:
        raise ValueError(f"{n} rows can't be split into train and valid")
    n_valid = math.ceil(n * valid_size) if isinstance(valid_size, float) and valid_size < 1 else int(valid_size)
    if not 0 < n_valid < n:
        raise ValueError(f"valid_size {valid_size} makes {n_valid} of {n} rows valid; both sides need rows")
    if shuffle:
        is_valid = _up_to(nth_in_hash_order(df, n_valid, seed, id_col), seed, id_col)
    else:
        is_valid = F.col(id_col) > F.lit(_nth_id(df, n, n - n_valid, id_col))
    return df.withColumn(split_col, F.when(is_valid, "valid").otherwise("train"))


def _nth_id(df: DataFrame, n: int, place: int, id_col: str) -> object:
    """The id at `place` (from 1) of n: a sketch encloses it, and only ids between its two
    values are put in order."""
    ends = df.agg(F.percentile_approx(id_col, [max(place / n - 2e-4, 0.0), min(place / n + 2e-4, 1.0)], 10_000)).first()[0]
    i = F.col(id_col)
    below = df.where(i < ends[0]).count()
    return df.where(i.between(*ends)).select(i.alias("i")).orderBy("i").offset(place - below - 1).limit(1).first()["i"]


def kfold_assign(df: DataFrame, n_splits: int = 5, seed: int = 42, id_col: str = C.ID_COL,
                 fold_col: str = "fold") -> DataFrame:
    """K3/K7: shuffled k-fold, fold numbers 1..k (one repeat)."""
    if n_splits < 2:
        raise ValueError(f"{n_splits} splits: folds need 2 or more")
    ids = df.select(F.col(id_col).alias("__id"), hash_order(id_col, seed).alias("__h"))
    dealt = counted_rank(ids, [], "__h", "__id").select("__id", ((F.col("__rank") - 1) % n_splits + 1).cast("int").alias(fold_col))
    return df.join(dealt, df[id_col].eqNullSafe(F.col("__id"))).drop("__id")


def counted_rank(ids: DataFrame, group: list[str], h: str, id_col: str) -> DataFrame:
    """Adds `__rank`, the place in hash order within each `group`, from counts: rows fall
    into 65,536 classes by their hashes' first digits; a row's place is the number of
    rows in the classes before (a running sum over the counts) plus its place in its
    class. Nothing is sorted as a whole, and only ids, groups and hashes are moved."""
    d = ids.withColumn("__class", F.substring(h, 1, 4))
    counts = d.groupBy(*group, "__class").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*group).orderBy("__class").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.withColumn("__start", F.sum("__n").over(w) - F.col("__n")).drop("__n")
    within = F.row_number().over(Window.partitionBy(*group, "__class").orderBy(h, id_col))
    renamed = starts.withColumnsRenamed({c: f"__s_{c}" for c in [*group, "__class"]})
    on = [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in [*group, "__class"]]
    out = d.withColumn("__within", within).join(renamed, on, "left")
    return out.withColumn("__rank", F.col("__start") + F.col("__within")).drop("__class", "__start", "__within", *[f"__s_{c}" for c in [*group, "__class"]])


# ------------------------------------------------------- stratification labels
def collapse_rare_labels(combos: DataFrame, primary: str, fallbacks: list[str], n_splits: int,
                         weight_col: str = "__n", out_col: str = "label") -> DataFrame:
    """K6 on a table of distinct label combinations with their row counts.

    Per fallback level: labels with fewer than n_splits rows are rare; every
    row whose fallback label equals the fallback label of some rare row takes
    the fallback label. Leftover rare labels -> `__ALL__`; if `__ALL__` itself
    is still rare, everything becomes `__ALL__`. The table has one row per
    combination (bounded by the label domains), so these windows are small.
    """
    cur = combos.withColumn(out_col, F.col(primary))
    for fb in fallbacks:
        cnt = F.sum(weight_col).over(Window.partitionBy(out_col))
        cur = cur.withColumn("__rare", cnt < n_splits)
        hit = F.max(F.col("__rare").cast("int")).over(Window.partitionBy(fb)) > 0
        cur = cur.withColumn(out_col, F.when(hit, F.col(fb)).otherwise(F.col(out_col))).drop("__rare")
    cnt = F.sum(weight_col).over(Window.partitionBy(out_col))
    cur = cur.withColumn(out_col, F.when(cnt < n_splits, F.lit(C.ALL_LABEL)).otherwise(F.col(out_col)))
    cnt = F.sum(weight_col).over(Window.partitionBy(out_col))
    still = F.max((cnt < n_splits).cast("int")).over(Window.partitionBy()) > 0
    return cur.withColumn(out_col, F.when(still, F.lit(C.ALL_LABEL)).otherwise(F.col(out_col)))


def stratification_labels(df: DataFrame, n_splits: int = 5, price_bins: int = 5, target_col: str = C.TARGET_COL,
                          id_col: str = C.ID_COL, age_col: str = "car_age_years", model_col: str = "model",
                          label_col: str = "strat_label") -> DataFrame:
    """K5 + K6: price_bin|age_bin|model_freq_bin with fallbacks price|age,
    price, age; rare labels collapsed on the combination table, which is
    joined back by broadcast (at most (price_bins+1) x 6 x 8 rows)."""
    if price_bins < 2:
        raise ValueError(f"{price_bins} price bins: strata need 2 or more")
    rows = price_quantile_bin(df, target_col, id_col, price_bins, "__pbin")
    rows = rows.withColumn("__abin", age_bin_expr(age_col))
    mkey = F.coalesce(F.trim(F.col(model_col).cast("string")), F.lit(C.MISSING_CATEGORY))
    rows = rows.withColumn("__mkey", mkey)
    mcount = rows.groupBy("__mkey").agg(F.count(F.lit(1)).cast("double").alias("__mcount"))
    rows = keyed.attach(rows, mcount, ["__mkey"]).withColumn("__fbin", frequency_bin("__mcount"))
    combos = (rows.groupBy("__pbin", "__abin", "__fbin").agg(F.count(F.lit(1)).alias("__n"))
              .withColumns({"__full": F.concat_ws("|", "__pbin", "__abin", "__fbin"),
                            "__pa": F.concat_ws("|", "__pbin", "__abin")}))
    labels = collapse_rare_labels(combos, "__full", ["__pa", "__pbin", "__abin"], n_splits, out_col=label_col)
    labels = labels.select("__pbin", "__abin", "__fbin", label_col)
    out = rows.join(F.broadcast(labels), ["__pbin", "__abin", "__fbin"])
    return out.drop("__pbin", "__abin", "__fbin", "__mkey", "__mcount")


def stratified_assign(df: DataFrame, n_splits: int = 5, repeats: int = 3, seed: int = 42,
                      price_bins: int = 5, id_col: str = C.ID_COL, label_col: str = "strat_label",
                      target_col: str = C.TARGET_COL) -> DataFrame:
    """K4: repeated stratified assignment table (id, repeat, fold, label).
    Repeat r uses seed + r - 1; inside each label rows are dealt round-robin
    in hash order."""
    if n_splits < 2 or repeats < 1:
        raise ValueError(f"{n_splits} splits, {repeats} repeats: folds need 2 or more splits and 1 or more repeats")
    labelled = stratification_labels(df.select(id_col, target_col, "car_age_years", "model"), n_splits,
                                     price_bins, target_col, id_col, label_col=label_col)
    labelled = saved(labelled, "labels")
    per_repeat = labelled.select(id_col, label_col).withColumn(
        "repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    per_repeat = per_repeat.withColumn("__h", hash_order(id_col, F.col("repeat") + F.lit(seed - 1)))
    ranked = counted_rank(per_repeat, ["repeat", label_col], "__h", id_col)
    return ranked.select(id_col, "repeat", ((F.col("__rank") - 1) % n_splits + 1).cast("int").alias("fold"), label_col)


def cv_plan(df: DataFrame, n_splits: int = 5, strategy: str = "repeated_stratified", repeats: int = 3,
            seed: int = 42, price_bins: int = 5, id_col: str = C.ID_COL) -> DataFrame:
    """K4 dispatcher: `kfold` (one repeat) or `repeated_stratified`."""
    if strategy == "kfold":
        return kfold_assign(df.select(id_col), n_splits, seed, id_col).withColumn("repeat", F.lit(1))
    if strategy != "repeated_stratified":
        raise ValueError(f"a plan is kfold or repeated_stratified, not {strategy}")
    return stratified_assign(df, n_splits, repeats, seed, price_bins, id_col)


def plan_summary(plan: DataFrame, label_col: str = "strat_label") -> DataFrame:
    """K4 metadata of an assignment table: one row (total_folds, label_count, smallest_label);
    a plan without labels has one."""
    label = F.col(label_col) if label_col in plan.columns else F.lit(C.ALL_LABEL)
    sizes = plan.groupBy("repeat", label.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.max("fold").alias("k"))
    return sizes.agg((F.countDistinct("repeat") * F.max("k")).alias("total_folds"), F.countDistinct("label").alias("label_count"),
                     F.min("n").alias("smallest_label"))
