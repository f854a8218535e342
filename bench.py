"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed into Spark's no-op sink (nothing is collected)
and timed end to end, including its planning-time jobs. Prints one JSON line:
seconds and number of Spark jobs per query, and what two single-pass operators
take against their looped forms on the same rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from foldframe import config as C  # noqa: E402
from foldframe.operators import blend, encode, folds  # noqa: E402
from foldframe.plans import registry  # noqa: E402
from foldframe.session import get_session, saved  # noqa: E402

HEADLINE = [
    "feature_frame", "transductive_features", "count_encoding", "model_age_stats",
    "price_quantile_bins", "stratified_assign", "oof_te", "te_all", "smoothed_te",
    "weights_legacy", "error_report", "blend_grid", "meta_cv",
]
FOLDS = 5


def timed(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> tuple[float, int]:
    """Seconds and Spark jobs that a query takes."""
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    began = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - began, 3), len(sc.statusTracker().getJobIdsForGroup(name))


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def loops(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Aggregate-once encoding and single-pass meta-CV against one pass per fold."""
    rows = saved(folds.kfold_assign(registry.enc_frame(spark, sf_dir).where(F.col("is_train")), FOLDS, 42), "bench-rows")
    matrix = saved(registry.oof_matrix(spark, sf_dir), "bench-matrix")
    grid = saved(blend.weight_grid(spark, registry.BLEND_MODELS, registry.BLEND_STEP), "bench-grid")

    def encode_by_fold() -> DataFrame:
        return union([encode.fit_price_proxy_encoder(rows.where(F.col("fold") != f)).transform(rows.where(F.col("fold") == f))
                      for f in range(1, FOLDS + 1)])

    def search_by_fold() -> DataFrame:
        return union([blend.search_best_weights(matrix.where(F.col("meta_fold") != f), grid, 1) for f in range(1, FOLDS + 1)])

    return {name: timed(spark, name, make)[0] for name, make in {
        "encode_once": lambda: encode.build_oof_price_proxy_features(rows, "fold", FOLDS, C.TARGET_COL),
        "encode_by_fold": encode_by_fold,
        "meta_cv_one_pass": lambda: blend.run_meta_cv(matrix, grid, "meta_fold")[0],
        "meta_cv_by_fold": search_by_fold}.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    only = sys.argv[1:] or HEADLINE
    found = {name: timed(spark, name, lambda n=name: registry.QUERIES[n](spark, sf_dir)) for name in only}
    times = {k: s for k, (s, _) in found.items()}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "jobs": {k: n for k, (_, n) in found.items()}, "against_loops": loops(spark, sf_dir),
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))


if __name__ == "__main__":
    main()
