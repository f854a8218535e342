"""Cleaning and projection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.columns import nan_to_null, to_double, to_integral
from . import validate as V

# Raw numeric columns that are whole-number codes in the listing schema.
_INTEGRAL = {"SaleID", "name", "regDate", "creatDate", "brand", "regionCode", "seller", "offerType"}


def _v_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("v_")]


def normalize_missing_values(df: DataFrame) -> DataFrame:
    """Exact-cell missing tokens -> NULL in text columns; NaN -> NULL in
    floating columns. One projection."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(*C.MISSING_TOKENS), F.lit(None).cast("string")).otherwise(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def clean_not_repaired_damage(df: DataFrame, col: str = "notRepairedDamage") -> DataFrame:
    """Trimmed text; `-` and empty become NULL."""
    if col not in df.columns:
        return df
    t = F.trim(F.col(col).cast("string"))
    return df.withColumn(col, F.when(t.isin("-", ""), F.lit(None).cast("string")).otherwise(t))


def convert_numeric_columns(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Coerce the raw numeric columns and every `v_*` column; text that is
    not a number becomes NULL. Whole-number codes stay bigint."""
    selected = list(columns or C.RAW_NUMERIC_COLUMNS)
    selected += [c for c in _v_columns(df) if c not in selected]
    present = set(df.columns)
    exprs = {}
    for c in selected:
        if c not in present:
            continue
        exprs[c] = to_integral(c) if c in _INTEGRAL else to_double(c)
    return df.withColumns(exprs) if exprs else df


def to_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C4: coerce the feature base numerics (+ v_*) before formulas run."""
    cols = [c for c in list(columns) + _v_columns(df) if c in df.columns]
    exprs = {}
    for c in dict.fromkeys(cols):
        dt = df.schema[c].dataType
        if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
            continue
        exprs[c] = to_double(c)
    return df.withColumns(exprs) if exprs else df


def clean_dataframe(df: DataFrame, dataset_name: str = "data", require_target: bool | None = None,
                    validate: bool = True) -> DataFrame:
    """C1 -> C2 -> C3 -> V3."""
    out = convert_numeric_columns(clean_not_repaired_damage(normalize_missing_values(df)))
    if validate:
        V.validate_raw_dataframe(out, dataset_name=dataset_name, require_target=require_target)
    return out


def clean_train_data(df: DataFrame, validate: bool = True) -> DataFrame:
    return clean_dataframe(df, "train", require_target=True, validate=validate)


def clean_test_data(df: DataFrame, validate: bool = True) -> DataFrame:
    return clean_dataframe(df, "test", require_target=False, validate=validate)


def category_text(col: str) -> F.Column:
    """C6 rule for one column: trimmed text, tokens to missing, `__MISSING__`."""
    t = F.trim(F.col(col).cast("string"))
    if col == "notRepairedDamage":
        t = (F.when(t.isin("-", ""), F.lit(None).cast("string"))
             .when(t == "0.0", F.lit("0")).when(t == "1.0", F.lit("1")).otherwise(t))
    else:
        t = F.when(t.isin("", "nan", "NaN"), F.lit(None).cast("string")).otherwise(t)
    return F.coalesce(t, F.lit(C.MISSING_CATEGORY))


def normalize_categorical_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Category columns -> normalised string keys."""
    cols = [c for c in (columns or C.CATEGORICAL_COLUMNS) if c in df.columns]
    return df.withColumns({c: category_text(c) for c in cols}) if cols else df


def add_categorical_features(df: DataFrame, add_counts: bool = False) -> DataFrame:
    """C6, then optional count encoding."""
    out = normalize_categorical_columns(df)
    if add_counts:
        from .features import add_count_encoding
        out = add_count_encoding(out)
    return out


def finalize_model_feature_frame(df: DataFrame, drop_unused_columns: bool = False) -> DataFrame:
    """C7 without counts, optionally drop non-feature columns."""
    out = add_categorical_features(df, add_counts=False)
    if not drop_unused_columns:
        return out
    return out.drop(*[c for c in C.DROP_FROM_MODEL_FEATURES if c in out.columns])


def prediction_projection(df: DataFrame, id_col: str = C.ID_COL, target_col: str = C.TARGET_COL,
                          pred_col: str = "prediction") -> DataFrame:
    """(SaleID, price, prediction, abs_error) validation table."""
    return df.select(id_col, target_col, pred_col,
                     F.abs(F.col(target_col) - F.col(pred_col)).alias("abs_error"))


def submission_projection(df: DataFrame, id_col: str = C.ID_COL, pred_col: str = "price") -> DataFrame:
    """(SaleID, price) submission table."""
    missing = {id_col, pred_col} - set(df.columns)
    if missing:
        raise ValueError(f"a prediction table has {id_col} and {pred_col}; this one lacks {sorted(missing)}")
    return df.select(F.col(id_col), F.col(pred_col).alias("price"))
