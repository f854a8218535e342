"""Validation (V1-V4): column checks are metadata only; all value-range checks
run as a single aggregate job over the table."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import to_double


def validate_required_columns(df: DataFrame, required: Iterable[str], dataset_name: str = "data") -> DataFrame:
    """V1: raise if any required column is absent (no Spark job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{dataset_name} lacks {missing}")
    return df


def _range_sums(df: DataFrame) -> tuple[list[Column], list[tuple[str, str, bool]]]:
    """Aggregates that count rows and values out of range, and (check, column, whether a
    single one fails) of each check."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    checks = []
    if C.TARGET_COL in df.columns:
        p = to_double(C.TARGET_COL)
        aggs.append(F.sum(F.when(p < 0, 1).otherwise(0)).alias("__bad_price"))
        checks.append(("price", "__bad_price", True))
    for col, (lo, hi) in C.VALUE_RANGE_CHECKS.items():
        if col not in df.columns:
            continue
        v = to_double(col)
        aggs.append(F.sum(F.when((v < lo) | (v > hi), 1).otherwise(0)).alias(f"__bad_{col}"))
        checks.append((col, f"__bad_{col}", False))
    return aggs, checks


def range_report(df: DataFrame, strict: bool = False) -> DataFrame:
    """V2 as a table: one row per check with bad count, row count, bad rate and
    whether it fails. Missing values count as in range. One aggregate job."""
    aggs, checks = _range_sums(df)
    if not checks:
        return df.sparkSession.createDataFrame(
            [], "check string, bad_count bigint, row_count bigint, bad_rate double, failed boolean")
    one = df.agg(*aggs)
    stack = ", ".join(f"'{name}', cast({alias} as bigint), {str(any_fails).lower()}"
                      for name, alias, any_fails in checks)
    long = one.selectExpr("__rows", f"stack({len(checks)}, {stack}) as (check, bad_count, any_fails)")
    rate = F.try_divide(F.col("bad_count").cast("double"), F.col("__rows").cast("double"))
    fails = F.when(F.col("any_fails") | F.lit(strict), F.col("bad_count") > 0) \
        .otherwise(rate > F.lit(C.MAX_OUT_OF_RANGE_RATE))
    return long.select(
        "check", "bad_count", F.col("__rows").alias("row_count"),
        F.coalesce(rate, F.lit(0.0)).alias("bad_rate"), F.coalesce(fails, F.lit(False)).alias("failed"))


def validate_value_ranges(df: DataFrame, dataset_name: str = "data", strict: bool = False) -> DataFrame:
    """V2: raise when a check fails (price < 0 anywhere; other ranges when the
    out-of-range share exceeds 0.1 %, or any in strict mode)."""
    _raise_for([(r["check"], r["bad_rate"]) for r in range_report(df, strict).collect() if r["failed"]], dataset_name)
    return df


def _raise_for(bad: list[tuple[str, float]], dataset_name: str) -> None:
    if bad:
        details = "; ".join(f"{check} out-of-range rate={rate:.4%}" for check, rate in bad)
        raise ValueError(f"{dataset_name} has too many values out of range ({details}); are its fields split at every single space?")


def observed(df: DataFrame, dataset_name: str = "data", require_target: bool = False, strict: bool = False,
             bad_rows: str | None = None) -> tuple[DataFrame, Callable[[], None]]:
    """V2/V3 without a pass of their own: `df` with its checks observed, and a function that
    raises for them once the frame has been written. Columns are checked at once.
    `bad_rows` names a column that is set on malformed rows."""
    validate_required_columns(df, C.COMMON_REQUIRED_COLUMNS, dataset_name)
    if require_target and C.TARGET_COL not in df.columns:
        raise ValueError(f"{dataset_name} has no target {C.TARGET_COL}")
    aggs, checks = _range_sums(df)
    seen = Observation(f"checks of {dataset_name}")
    malformed = F.count(bad_rows) if bad_rows else F.sum(F.lit(0))

    def check() -> None:
        got = seen.get
        if not got["__rows"]:
            raise ValueError(f"{dataset_name} has no rows")
        if got["__malformed"]:
            raise ValueError(f"{dataset_name} has {got['__malformed']} rows whose number of fields is not that of its header")
        rates = [(name, got[alias] / got["__rows"], one) for name, alias, one in checks]
        _raise_for([(name, rate) for name, rate, one in rates if rate > (0 if one or strict else C.MAX_OUT_OF_RANGE_RATE)], dataset_name)

    return df.observe(seen, *aggs, malformed.alias("__malformed")), check


def validate_raw_dataframe(df: DataFrame, dataset_name: str = "data", require_target: bool | None = None,
                           strict: bool = False) -> DataFrame:
    """V3: non-empty, required columns, target presence, value ranges."""
    if df.isEmpty():
        raise ValueError(f"{dataset_name} has no rows")
    validate_required_columns(df, C.COMMON_REQUIRED_COLUMNS, dataset_name)
    if require_target is None:
        require_target = dataset_name.strip().lower() in ("train", "training")
    if require_target and C.TARGET_COL not in df.columns:
        raise ValueError(f"{dataset_name} has no target {C.TARGET_COL}")
    return validate_value_ranges(df, dataset_name, strict)


def validate_ranges_only(df: DataFrame, dataset_name: str = "data") -> DataFrame:
    """V4: the trainer's guard (ranges only, not strict)."""
    return validate_value_ranges(df, dataset_name, strict=False)
