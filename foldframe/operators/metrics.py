"""Exact quantiles, regression metrics and reports.

Quantiles are exact (linear interpolation, as pandas `quantile`) and come from
`quantiles`, which orders only a narrow band of the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import whole_quantiles


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float]) -> dict[float, float | None]:
    """pandas-compatible quantiles of a column's non-null values, linearly interpolated."""
    return {q: v for (_, q), v in whole_quantiles(df, [col], list(qs)).items()}


def regression_metrics(df: DataFrame, y: str, pred: str) -> DataFrame:
    """One aggregate: MAE, RMSE, R2 (NULL when the target has no variance)."""
    e = F.col(y) - F.col(pred)
    return df.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"),
        F.count(F.lit(1)).alias("rows"))


def oof_aggregate(preds: DataFrame, id_col: str, cols: Sequence[str], count_col: str = "cv_prediction_count") -> DataFrame:
    """Per row, mean of each prediction/flag column over the folds that
    validated it, and how many did. Raises if a row was never validated is
    the caller's check (`count_col` == 0 cannot occur after a groupBy)."""
    return preds.groupBy(id_col).agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias(count_col))


def error_report(df: DataFrame, abs_error: str, id_col: str) -> DataFrame:
    """MAE, abs-error quantiles .5/.75/.9/.95/.99 and the share of the
    total error held by the worst 10 % of rows (max(1, int(0.1 n)) rows).

    The worst rows are not ranked: the order statistic below them bounds their errors, the
    larger ones are summed and rows equal to it fill up what is missing, so that
    which of several equal ones are meant does not matter."""
    qs = [0.5, 0.75, 0.9, 0.95, 0.99]
    vals = df.where(F.col(abs_error).isNotNull()).select(F.col(abs_error).cast("double").alias("e"))
    n, mean, total = vals.agg(F.count(F.lit(1)), F.avg("e"), F.sum("e")).first()
    worst, share = max(1, int(n * 0.1)), None
    found = exact_quantiles(vals, "e", [*qs, (n - worst) / max(n - 1, 1)]) if n else dict.fromkeys(qs)
    if total:
        # position n - worst (from 0) is the least of the worst rows' errors
        least = _order_statistic(vals, n - worst, found[(n - worst) / max(n - 1, 1)])
        above, held = vals.where(F.col("e") > least).agg(F.sum("e"), F.count(F.lit(1))).first()
        share = ((above or 0.0) + (worst - held) * least) / total
    rows = [("aggregated_oof_mae", mean), ("abs_error_median", found[0.5]), ("abs_error_p75", found[0.75]), ("abs_error_p90", found[0.9]),
            ("abs_error_p95", found[0.95]), ("abs_error_p99", found[0.99]), ("worst_10pct_abs_error_share", share)]
    return df.sparkSession.createDataFrame([(k, None if v is None else float(v)) for k, v in rows], "metric string, value double")


def _order_statistic(vals: DataFrame, position: int, near: float) -> float:
    """The value at `position` of the column e, given a value that interpolates between it
    and its neighbours: the rounding of the position is undone by counting."""
    below, at_most = vals.agg(F.count(F.when(F.col("e") < near, 1)), F.count(F.when(F.col("e") <= near, 1))).first()
    if below <= position < at_most:
        return near
    side = F.max(F.when(F.col("e") < near, F.col("e"))) if position < below else F.min(F.when(F.col("e") > near, F.col("e")))
    return vals.agg(side).first()[0]


def cv_summary(fold_metrics: DataFrame, oof: DataFrame | None = None, target_col: str = "price") -> DataFrame:
    """Mean and population std of fold MAE and global MAE; with the OOF table (oof_pred,
    global_oof_pred) also the error of the averaged predictions, aggregated_oof_mae and
    aggregated_global_oof_mae."""
    out = fold_metrics.agg(
        F.avg("mae").alias("mae_mean"), F.stddev_pop("mae").alias("mae_std"),
        F.avg("global_mae").alias("global_mae_mean"), F.stddev_pop("global_mae").alias("global_mae_std"),
        F.count(F.lit(1)).alias("total_folds"))
    if oof is None:
        return out
    err = lambda c: F.avg(F.abs(F.col(target_col) - F.col(c)))
    whole = oof.agg(err("oof_pred").alias("aggregated_oof_mae"), err("global_oof_pred").alias("aggregated_global_oof_mae"))
    return out.join(F.broadcast(whole))  # a row each


def profile_report(train: DataFrame, target: str, id_col: str, preds: DataFrame | None = None,
                   pred_col: str = "price", n_numeric: int | None = None,
                   n_categorical: int | None = None) -> DataFrame:
    """Long-form table of row counts and target/prediction summaries
    (medians exact via the distributed rank)."""
    t = train.agg(F.count(F.lit(1)).alias("n"), F.min(target).alias("mn"),
                  F.avg(target).alias("mean"), F.max(target).alias("mx")).first()
    md = exact_quantiles(train, target, [0.5])[0.5]
    rows = [("train_rows", float(t["n"])), ("target_min", t["mn"]), ("target_median", md),
            ("target_mean", t["mean"]), ("target_max", t["mx"])]
    if preds is not None:
        p = preds.agg(F.count(F.lit(1)).alias("n"), F.min(pred_col).alias("mn"), F.max(pred_col).alias("mx")).first()
        pmd = exact_quantiles(preds, pred_col, [0.5])[0.5]
        rows += [("test_rows", float(p["n"])), ("test_prediction_min", p["mn"]),
                 ("test_prediction_median", pmd), ("test_prediction_max", p["mx"])]
    if n_numeric is not None:
        rows.append(("numeric_feature_count", float(n_numeric)))
    if n_categorical is not None:
        rows.append(("categorical_feature_count", float(n_categorical)))
    return train.sparkSession.createDataFrame(
        [(k, None if v is None else float(v)) for k, v in rows], "metric string, value double")
