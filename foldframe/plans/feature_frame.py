"""Feature-frame plans: F0 (ordered feature steps), P1 (train+test statistics),
P2 (per-table statistics), P3 (P2 + out-of-fold price proxies), P4 (no-op)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean, encode, features
from ..operators.folds import kfold_assign
from ..session import saved


@dataclass(frozen=True)
class PreparedFrame:
    """Train and test rows in one frame (`__is_train__` flag, `price` NULL for
    test rows) plus the column lists the model uses. The id column replaces
    positional alignment."""

    frame: DataFrame
    numeric_columns: tuple[str, ...]
    categorical_columns: tuple[str, ...]
    id_col: str = C.ID_COL
    target_col: str = C.TARGET_COL

    @property
    def train(self) -> DataFrame:
        return self.frame.where(F.col(C.TRAIN_FLAG) == 1)

    @property
    def test(self) -> DataFrame:
        return self.frame.where(F.col(C.TRAIN_FLAG) == 0)

    def with_numeric(self, extra: list[str]) -> "PreparedFrame":
        return replace(self, numeric_columns=tuple(self.numeric_columns) + tuple(extra))


def add_price_proxy_features(df: DataFrame) -> DataFrame:
    """Deliberately a no-op (full-train price statistics would leak)."""
    return df


# the steps of F0 in their fixed order: name -> what it does with (rows, statistics, minimal group size)
STEPS = {
    "counts": lambda df, st, n: features.add_count_encoding(df, stats=st),
    "group_stats": lambda df, st, n: features.add_group_statistics(df, st),
    "brand_relative": lambda df, st, n: features.add_brand_relative_features(df, st),
    "depreciation": lambda df, st, n: features.add_depreciation_features(df),
    "power_age": lambda df, st, n: features.add_power_age_features(df),
    "age_detail": lambda df, st, n: features.add_age_detail_features(df),
    "model_age_stats": lambda df, st, n: features.add_model_age_group_stats(df, n, st),
    "interactions": lambda df, st, n: features.add_interaction_features(df),
}
KEYED_STEPS = ("counts", "group_stats", "brand_relative", "model_age_stats")
DEFAULT_STEPS = ("counts", "group_stats")


def build_features(df: DataFrame, steps: Sequence[str] = DEFAULT_STEPS, power_bin: bool = False, min_group: int = 20,
                   drop_unused: bool = False) -> DataFrame:
    """the chosen steps in the order of STEPS. Group keys are still numeric codes
    here; they become category strings only in the final step. The keyed statistics of
    all steps are one aggregate over the row-local columns."""
    if unknown := set(steps) - set(STEPS):
        raise ValueError(f"{sorted(unknown)} are none of the steps {list(STEPS)}")
    out = features.add_date_features(features.normalize_numeric_columns(df, power_bin))
    stats = None
    if set(steps) & set(KEYED_STEPS):
        # read by every statistic and by the rows themselves: made once
        out = saved(out, "listing-rows")
        stats = features.listing_statistics(out, C.FREQUENCY_COLUMNS if "counts" in steps else (), "group_stats" in steps,
                                            "brand_relative" in steps, "model_age_stats" in steps)
    for name, step in STEPS.items():
        if name in steps:
            out = step(out, stats, min_group)
    out = add_price_proxy_features(out)
    return clean.finalize_model_feature_frame(out, drop_unused)


def build_train_features(df: DataFrame, **choice) -> DataFrame:
    """Statistics over this table only; `choice` as for build_features."""
    return build_features(df, **choice)


def build_test_features(df: DataFrame, **choice) -> DataFrame:
    return build_features(df, **choice)


def build_train_test_features(train: DataFrame, test: DataFrame, price_proxies: bool = False, folds: int = 5, seed: int = 42,
                              **choice) -> tuple[DataFrame, DataFrame]:
    """P2 on both tables; with `price_proxies`, the train rows' out-of-fold price
    means and the test rows' full-train ones are appended (T6)."""
    if C.TARGET_COL not in train.columns:
        raise ValueError(f"train rows need the column {C.TARGET_COL}")
    a, b = build_train_features(train, **choice), build_test_features(test, **choice)
    if not price_proxies:
        return a, b
    assigned = kfold_assign(a, folds, seed, fold_col="__fold")
    a, b, _ = encode.build_oof_and_apply_price_proxy_features(assigned, b, "__fold", folds)
    return a.drop("__fold"), b


def prepare_features(train: DataFrame, test: DataFrame, steps: Sequence[str] = DEFAULT_STEPS, **choice) -> PreparedFrame:
    """Union train and test, compute every statistic over both
    (transductive by design), keep id/target/flag, list the model columns."""
    if C.TARGET_COL not in train.columns:
        raise ValueError("Training data must contain a 'price' column.")
    full = train.withColumn(C.TRAIN_FLAG, F.lit(1)).unionByName(
        test.withColumn(C.TRAIN_FLAG, F.lit(0)), allowMissingColumns=True)
    full = full.withColumn(C.TARGET_COL, F.when(F.col(C.TRAIN_FLAG) == 1, F.col(C.TARGET_COL).cast("double")))
    steps = [s for s in ("counts", *steps) if s != "depreciation"]
    # The target rides along untouched (no feature step reads it), so no
    # re-alignment join is needed; it is excluded from the model columns.
    featured = build_features(full, steps, **choice)
    drop = [c for c in C.DROP_FROM_MODEL_FEATURES if c in featured.columns and c not in (C.ID_COL, C.TRAIN_FLAG)]
    featured = featured.drop(*drop)
    cats = tuple(c for c in C.CATEGORICAL_COLUMNS if c in featured.columns)
    skip = (C.ID_COL, C.TRAIN_FLAG, C.TARGET_COL)
    nums = tuple(c for c in featured.columns if c not in cats and c not in skip)
    return PreparedFrame(frame=featured, numeric_columns=nums, categorical_columns=cats)
