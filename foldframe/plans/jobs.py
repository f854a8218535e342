"""Jobs that read tables, run operators and write their results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators import blend, clean, folds, metrics, ml, validate
from ..operators.quantiles import whole_quantiles
from ..session import delete, saved
from ..sources import io
from . import feature_frame


# ------------------------------------------------------------ B10 + S10
def blend_summary(matrix: DataFrame, names: Sequence[str], fold_col: str, step: float, mode: str = "grid",
                  top_k: int = 200) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary, top candidates, meta-CV choices) of an OOF matrix with `preds`.

    One scoring pass over the grid gives the single models' errors (the grid's
    corners), the best weights and the choice without each fold; in `optimize` mode
    the last two come from the local search instead."""
    spark, n = matrix.sparkSession, len(names)
    grid = saved(blend.weight_grid(spark, n, step), "blend-grid")
    if mode == "optimize":
        found = saved(blend.optimize(matrix, n, step, fold_col), "blend-found").withColumn("cand_id", F.xxhash64("w"))
        top = found.where("meta_fold = 0").select(F.lit(1).alias("rank"), "cand_id", "w", "mae")
        choices = found.where("meta_fold > 0").select("meta_fold", "cand_id", F.col("mae").alias("train_mae"), "valid_mae", "w")
        corners = grid.where(F.array_max("units") == blend.units_of(step))
        scores = saved(blend.score_candidates(matrix, corners, fold_col=fold_col), "blend-scores")
    elif mode == "grid":
        scores = saved(blend.score_candidates(matrix, grid, fold_col=fold_col), "blend-scores")
        top = saved(blend.best_of_scores(scores, grid, top_k, digits=6), "blend-top")
        choices = saved(blend.meta_choices(scores, grid), "blend-choices")
    else:
        raise ValueError(f"mode is grid or optimize, not {mode}")
    corner = grid.where(F.array_max("units") == blend.units_of(step)).select("cand_id", F.array_position("w", 1.0).alias("model"))
    single = scores.join(corner, "cand_id").groupBy("model").agg((F.sum("err") / F.sum("n")).alias("value"), F.sum("n").alias("n"))
    label = F.element_at(F.array(*[F.lit(f"base_oof_mae_{c}") for c in names]), F.col("model").cast("int"))
    oof = blend.meta_oof(matrix, choices, fold_col)
    rows = [
        single.select(label.alias("metric"), "value"),
        single.where("model = 1").select(F.lit("n_rows"), F.col("n").cast("double")),
        grid.agg(F.lit("grid_size"), F.count(F.lit(1)).cast("double")),
        top.where("rank = 1").select(F.lit("best_full_mae"), "mae"),
        oof.agg(F.lit("meta_cv_mae"), F.avg(F.abs(F.col(C.TARGET_COL) - F.col("oof_pred")))),
        choices.agg(F.lit("meta_cv_valid_mean"), F.avg("valid_mae")),
        choices.agg(F.lit("meta_cv_valid_std"), F.stddev_samp("valid_mae")),
    ]
    summary = rows[0]
    for part in rows[1:]:
        summary = summary.union(part)
    return summary, top, choices


def blend_job(oof: Sequence[tuple[str, DataFrame]], submissions: dict[str, DataFrame] | None, out_dir: str,
              step: float = 0.025, mode: str = "grid", top_k: int = 200, meta_folds: int = 5, seed: int = 7) -> DataFrame:
    """B1 -> B5/B8 -> blend -> B9 -> summary, with every result written under `out_dir`:
    top_candidates, meta_choices (parquet), oof_blend, meta_oof, submission,
    submission_components, summary (csv). Returns the summary."""
    names = [n for n, _ in oof]
    matrix = blend.with_pred_array(blend.load_oof_matrix(oof), names)
    matrix = saved(folds.kfold_assign(matrix, meta_folds, seed, fold_col="meta_fold"), "blend-matrix")
    summary, top, choices = blend_summary(matrix, names, "meta_fold", step, mode, top_k)
    best = [float(x) for x in top.where("rank = 1").first()["w"]]
    w = F.array(*[F.lit(x) for x in best])
    io.save_parquet(top, f"{out_dir}/top_candidates")
    io.save_parquet(choices, f"{out_dir}/meta_choices")
    io.save_csv(matrix.select(C.ID_COL, C.TARGET_COL, blend.blended("preds", w).alias("oof_pred")), f"{out_dir}/oof_blend")
    io.save_csv(blend.meta_oof(matrix, choices, "meta_fold"), f"{out_dir}/meta_oof")
    if submissions is not None:
        m = blend.with_pred_array(blend.load_submission_matrix(names, submissions), names)
        m = saved(m.withColumn(C.TARGET_COL, blend.blended("preds", w)), "blend-submission")
        io.save_csv(m.select(C.ID_COL, C.TARGET_COL), f"{out_dir}/submission")
        io.save_csv(m.select(C.ID_COL, C.TARGET_COL, *names), f"{out_dir}/submission_components")
        ends = m.agg(F.min(C.TARGET_COL).alias("min"), F.max(C.TARGET_COL).alias("max")).first()
        middle = whole_quantiles(m, [C.TARGET_COL], [0.5])[C.TARGET_COL, 0.5]
        rows = [("submission_min", ends["min"]), ("submission_median", middle), ("submission_max", ends["max"])]
        summary = summary.union(m.sparkSession.createDataFrame(rows, "metric string, value double"))
    io.save_csv(summary, f"{out_dir}/summary")
    return summary


# ------------------------------------------------------------ S11 / S12 / S8
def make_data(spark: SparkSession, train_path: str, test_path: str, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw train and test files, checked and cleaned, to out_dir/train and out_dir/test.

    Each file is read once: fields, target and ranges are observed while the cleaned rows are
    written, and a table that fails a check is deleted again."""
    for name, path, target in (("train", train_path, True), ("test", test_path, False)):
        raw = io.read_raw_listing(spark, path, name, keep_malformed=True)
        rows, check = validate.observed(clean.clean_dataframe(raw, name, validate=False), name, target, bad_rows=io.MALFORMED)
        io.save_parquet(rows.drop(io.MALFORMED), f"{out_dir}/{name}")
        try:
            check()
        except ValueError:
            delete(spark, f"{out_dir}/{name}")
            raise
    return io.read_parquet(spark, f"{out_dir}/train"), io.read_parquet(spark, f"{out_dir}/test")


def make_features(spark: SparkSession, data_dir: str, out_dir: str, **choice) -> tuple[DataFrame, DataFrame]:
    """Features of the tables that make_data wrote, each with its own statistics (P3),
    to out_dir/train and out_dir/test."""
    train, test = (io.read_parquet(spark, f"{data_dir}/{name}") for name in ("train", "test"))
    for name, df in zip(("train", "test"), feature_frame.build_train_test_features(train, test, **choice), strict=True):
        io.save_parquet(df, f"{out_dir}/{name}")
    return io.read_parquet(spark, f"{out_dir}/train"), io.read_parquet(spark, f"{out_dir}/test")


def make_submission(predictions: DataFrame, *paths: str) -> None:
    """(SaleID, price) of a prediction table, written to every path."""
    table = saved(clean.submission_projection(predictions), "submission")
    for path in paths:
        io.save_csv(table, path)


# ------------------------------------------------------------ S9: training, prediction
def train_job(train: DataFrame, test: DataFrame, plan: DataFrame, numeric: Sequence[str], categorical: Sequence[str], learner, out_dir: str, **how) -> DataFrame:
    """Cross-validation and full fit with all that they leave under `out_dir`:
    oof_predictions, valid_predictions, submission (csv), fold_metrics and metrics (csv,
    the latter long form, with the overall OOF error) and the model bundle. `how`: seg,
    target_mode, enc and rules. Returns the metrics as they were written."""
    spark = train.sparkSession
    predictions, per_fold = ml.cross_validate(train, plan, numeric, categorical, learner, **how)
    oof = saved(ml.oof_table(predictions), "train-oof")
    per_fold = saved(per_fold, "train-folds")
    full, details = ml.fit_full_and_predict(train, test, numeric, categorical, learner, bundle=f"{out_dir}/model", **how)
    submission = clean.submission_projection(full.select(C.ID_COL, F.col("prediction").alias(C.TARGET_COL)))
    io.write_standard_outputs(out_dir, oof, submission, oof.withColumn("prediction", F.col("oof_pred")))
    io.save_csv(per_fold, f"{out_dir}/fold_metrics")
    summary = metrics.cv_summary(per_fold, oof).first().asDict()
    numbers = {**summary, **{k: v for k, v in details.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}}
    rows = [(k, None if v is None else float(v)) for k, v in sorted(numbers.items())]
    io.save_csv(spark.createDataFrame(rows, "metric string, value double").coalesce(1), f"{out_dir}/metrics")
    return io.read_csv(spark, f"{out_dir}/metrics", T.StructType([T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType())]))


def predict_job(rows: DataFrame, bundle: str, out_path: str, routed: bool = False) -> DataFrame:
    """Predictions of `rows` from a saved bundle, written as a submission file; returns
    what was written."""
    spark = rows.sparkSession
    found = ml.predict_bundle(spark, bundle, rows, routed)
    io.save_csv(clean.submission_projection(found.select(C.ID_COL, F.col("prediction").alias(C.TARGET_COL))), out_path)
    return io.load_submission(spark, "prediction", out_path)


def blend_files_job(spark: SparkSession, oof_paths: dict[str, str], submission_paths: dict[str, str] | None, out_dir: str, **how) -> DataFrame:
    """`blend_job` on OOF and submission files by model name."""
    oof = [(n, io.load_oof(spark, n, p).withColumnRenamed(n, "oof_pred")) for n, p in oof_paths.items()]
    subs = {n: io.load_submission(spark, n, p).withColumnRenamed(n, C.TARGET_COL) for n, p in submission_paths.items()} if submission_paths else None
    return blend_job(oof, subs, out_dir, **how)
