"""Row-local features (D2, D4, F1-F3, F5, F6) and keyed group statistics
(F4, G1-G3, D6).

Row-local steps are single projections (`withColumns`) and stay inside one
whole-stage-codegen span. The keyed statistics of all steps come from stacked
aggregates (`keyed.KeyStatistics`), joined lazily once per key and step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.columns import clip, concat_key, flag, nullable_flag, safe_div
from ..functions.dates import age_bin, frequency_bin, parse_compact_date, power_bin_code
from . import keyed
from .clean import to_numeric


def _has(df: DataFrame, *cols: str) -> bool:
    return all(c in df.columns for c in cols)


# --------------------------------------------------------------------- power
def normalize_power_features(df: DataFrame, use_power_bin: bool = False) -> DataFrame:
    """outlier flag before the clip, clip to [0, 600], zero flag, optional
    bin code."""
    if "power" not in df.columns:
        return df
    p = F.col("power")
    lo, hi = C.POWER_CLIP
    out = df.withColumns({
        "power_outlier_flag": flag((p < lo) | (p > hi)),
        "power": clip(p, lo, hi),
    })
    out = out.withColumn("power_is_zero", flag(F.col("power") == 0))
    if use_power_bin:
        out = out.withColumn("power_bin", power_bin_code("power"))
    return out


def normalize_numeric_columns(df: DataFrame, use_power_bin: bool = False) -> DataFrame:
    """C4 + F1."""
    return normalize_power_features(to_numeric(df, C.FEATURE_NUMERIC_BASE), use_power_bin)


# --------------------------------------------------------------------- dates
def add_date_features(df: DataFrame) -> DataFrame:
    """Registration / listing date parts (weekday Monday=0) and age."""
    null_date = F.lit(None).cast("date")
    reg = parse_compact_date("regDate") if "regDate" in df.columns else null_date
    cre = parse_compact_date("creatDate") if "creatDate" in df.columns else null_date
    out = df.withColumns({"__reg": reg, "__cre": cre})
    r, c = F.col("__reg"), F.col("__cre")
    days = F.datediff(c, r)
    return out.withColumns({
        "reg_year": F.year(r), "reg_month": F.month(r), "reg_day": F.dayofmonth(r),
        "reg_weekday": F.weekday(r),
        "create_year": F.year(c), "create_month": F.month(c), "create_day": F.dayofmonth(c),
        "create_weekday": F.weekday(c),
        "car_age_days": days,
        "car_age_years": days.cast("double") / F.lit(C.DAYS_PER_YEAR),
    }).drop("__reg", "__cre")


def add_age_detail_features(df: DataFrame) -> DataFrame:
    """Months of age and 0/1 flags (missing age -> 0)."""
    exprs = {}
    if "car_age_days" in df.columns:
        exprs["car_age_months"] = clip(F.col("car_age_days").cast("double"), lower=0.0) / F.lit(C.DAYS_PER_MONTH)
    if "car_age_years" in df.columns:
        a = clip("car_age_years", lower=0.0)
        exprs["is_nearly_new_1y"] = flag(a <= 1)
        exprs["is_nearly_new_3y"] = flag(a <= 3)
    return df.withColumns(exprs) if exprs else df


# -------------------------------------------------------------- row formulas
def add_depreciation_features(df: DataFrame) -> DataFrame:
    """mileage per year (age > 0 only), age x mileage, nullable flags."""
    age = clip(F.col("car_age_years"), lower=0.0) if "car_age_years" in df.columns else F.lit(None).cast("double")
    km = F.col("kilometer").cast("double") if "kilometer" in df.columns else F.lit(None).cast("double")
    return df.withColumns({
        "kilometer_per_year": F.when(age > 0, safe_div(km, age)),
        "age_kilometer_interaction": age * km,
        "is_nearly_new_1y": nullable_flag(age <= 1),
        "is_old_car_10y": nullable_flag(age >= 10),
    })


def add_power_age_features(df: DataFrame) -> DataFrame:
    """power and mileage relative to age; base = clip0(age) (missing -> 0) + 1."""
    if "car_age_years" not in df.columns:
        return df
    age = clip("car_age_years", lower=0.0)
    base = F.coalesce(age, F.lit(0.0)) + F.lit(1.0)
    exprs = {}
    if "power" in df.columns:
        p = F.col("power").cast("double")
        exprs.update({
            "power_per_age_year": safe_div(p, base),
            "power_per_age_year_sqrt": safe_div(p, F.sqrt(base)),
            "power_age_product": p * age,
            "power_age_ratio": safe_div(p, base),
            "log_power_per_age": safe_div(F.log1p(clip(p, lower=0.0)), base),
        })
    if "kilometer" in df.columns:
        km = F.col("kilometer").cast("double")
        exprs.update({
            "kilometer_per_age_year": safe_div(km, base),
            "log_kilometer_per_age": safe_div(F.log1p(clip(km, lower=0.0)), base),
            "age_kilometer_product": age * km,
        })
    return df.withColumns(exprs) if exprs else df


def add_interaction_features(df: DataFrame) -> DataFrame:
    """power against its brand mean."""
    if not _has(df, "power", "brand_power_mean"):
        return df
    p, m = F.col("power"), F.col("brand_power_mean")
    return df.withColumns({
        "power_minus_brand_power_mean": p - m,
        "power_ratio_brand_power_mean": safe_div(p, m + F.lit(C.RATIO_EPS)),
    })


# ------------------------------------------------------------ keyed counts
def group_age_key() -> Column:
    """G2 key: raw model text and age bin, NULL when the model is missing."""
    return concat_key(F.col("model"), age_bin("car_age_years"))


def listing_statistics(source: DataFrame, counts: Sequence[str] = (), groups: bool = False, relative: bool = False,
                       model_age: bool = False) -> keyed.KeyStatistics:
    """All keyed statistics that the chosen steps need, from rows of `source` written once:
    F4 for `counts`, G1 (`groups`), F6/G3 (`relative`), G2 (`model_age`)."""
    keys = {c: F.col(c) for c in counts if c in source.columns}
    medians: list[tuple[str, str]] = []
    averaged: set[str] = set()
    has = lambda *c: _has(source, *c)
    if (groups or relative or model_age) and has("brand"):
        keys["brand"] = F.col("brand")
        averaged.add("brand")
        medians += [("brand", "power")] if groups and has("power") else []
    if (groups or model_age) and has("model", "power"):
        keys["model"] = F.col("model")
        averaged.add("model")
    if model_age and has(*MODEL_AGE_NEEDS):
        keys |= {"model_age": group_age_key(), keyed.KeyStatistics.ALL: F.lit("all")}
        averaged |= {"model_age", keyed.KeyStatistics.ALL}
        medians += [(k, v) for k in ("model_age", "model", keyed.KeyStatistics.ALL) for v in ("power", "kilometer")]
    values = [v for v in ("power", "kilometer", "car_age_years") if averaged and has(v)]
    return keyed.KeyStatistics(source, keys, values, medians, [k for k in keys if k not in averaged])


def add_count_encoding(df: DataFrame, columns: Sequence[str] | None = None,
                       stats: keyed.KeyStatistics | None = None) -> DataFrame:
    """`{col}_count` = rows sharing the key (missing key counted), double."""
    columns = [c for c in columns or C.FREQUENCY_COLUMNS if c in df.columns]
    if not columns:
        return df
    stats = stats or listing_statistics(df, counts=columns)
    for col in columns:
        df = stats.onto(df, col, {f"{col}_count": "count"})
    return df


def add_model_frequency_bin(df: DataFrame, model_col: str = "model",
                            output_col: str = "model_frequency_bin") -> DataFrame:
    """Row count per (trimmed, missing-filled) model key, binned f1..f51_plus."""
    if model_col not in df.columns:
        return df
    key = F.coalesce(F.trim(F.col(model_col).cast("string")), F.lit(C.MISSING_CATEGORY))
    counts = df.groupBy(key.alias("__mkey")).agg(F.count(F.lit(1)).cast("double").alias("__mcount"))
    out = keyed.attach(df, counts, [(key, "__mkey")])
    return out.withColumn(output_col, frequency_bin("__mcount")).drop("__mcount")


# ------------------------------------------------------------ group stats
def add_group_statistics(df: DataFrame, stats: keyed.KeyStatistics | None = None) -> DataFrame:
    """G1: brand power mean/median, brand kilometer mean, model power mean."""
    if not (_has(df, "brand") or _has(df, "model", "power")):
        return df
    stats = stats or listing_statistics(df, groups=True)
    brand = {}
    if _has(df, "power"):
        brand |= {"brand_power_mean": "power_mean", "brand_power_median": "power_median"}
    if _has(df, "kilometer"):
        brand |= {"brand_kilometer_mean": "kilometer_mean"}
    if _has(df, "brand") and brand:
        df = stats.onto(df, "brand", brand)
    if _has(df, "model", "power"):
        df = stats.onto(df, "model", {"model_power_mean": "power_mean"})
    return df


def add_brand_relative_features(df: DataFrame, stats: keyed.KeyStatistics | None = None) -> DataFrame:
    """F6 (+G3): power and mileage against brand means; brand mean of age."""
    exprs = {}
    for value in ("power", "kilometer"):
        mean = f"brand_{value}_mean"
        if _has(df, mean, value):
            exprs[f"{value}_minus_{mean}"] = F.col(value) - F.col(mean)
            exprs[f"{value}_ratio_{mean}"] = safe_div(value, F.col(mean) + F.lit(C.RATIO_EPS))
    out = df.withColumns(exprs) if exprs else df
    if _has(out, "brand", "car_age_years"):
        stats = stats or listing_statistics(df, relative=True)
        out = stats.onto(out, "brand", {"brand_car_age_years_mean": "car_age_years_mean"})
        out = out.withColumn("car_age_minus_brand_age_mean",
                             F.col("car_age_years") - F.col("brand_car_age_years_mean"))
    return out


MODEL_AGE_NEEDS = ("model", "brand", "car_age_years", "power", "kilometer")


def add_model_age_group_stats(df: DataFrame, min_count: int = 20, stats: keyed.KeyStatistics | None = None) -> DataFrame:
    """Model x age-bin support and peer statistics with back-off.

    Key = `model|age_bin` on the raw model text, NULL when the model is missing
    (all missing-model rows form one group). Medians back off group -> model
    -> global; means and stds group -> model -> brand -> global (std then 0).
    The group value is used when the group has >= min_count rows, even if it
    is itself NULL (then the later levels fill it).
    """
    if not _has(df, *MODEL_AGE_NEEDS, "model_count"):
        return df
    stats = stats or listing_statistics(df, model_age=True)
    p, k = F.col("power"), F.col("kilometer")
    short = {f"{v[0]}{m}": f"{v}_{s}" for v in ("power", "kilometer") for m, s in (("med", "median"), ("mean", "mean"), ("std", "std"))}
    out = stats.onto(df, "model_age", {"model_age_count": "count"} | {f"__g_{a}": b for a, b in short.items()})
    out = stats.onto(out, "model", {f"__m_{a}": b for a, b in short.items()})
    out = stats.onto(out, "brand", {f"__b_{a}": b for a, b in short.items() if not b.endswith("median")})
    everything = stats.parts[stats.ALL].first()
    glob = {a: everything[b] if everything else None for a, b in short.items()}

    def lit(v):
        return F.lit(v).cast("double")

    use = F.col("model_age_count") >= F.lit(float(min_count))

    def pick(gc, mc):
        return F.when(use, F.col(gc)).otherwise(F.col(mc))

    out = out.withColumns({
        "model_age_count_ratio": F.coalesce(
            safe_div(F.col("model_age_count"), F.col("model_count")), F.lit(0.0)),
        "model_age_power_median": F.coalesce(pick("__g_pmed", "__m_pmed"), lit(glob["pmed"])),
        "model_age_kilometer_median": F.coalesce(pick("__g_kmed", "__m_kmed"), lit(glob["kmed"])),
        "model_age_power_mean": F.coalesce(pick("__g_pmean", "__m_pmean"), F.col("__b_pmean"), lit(glob["pmean"])),
        "model_age_power_std": F.coalesce(pick("__g_pstd", "__m_pstd"), F.col("__b_pstd"), lit(glob["pstd"]),
                                          F.lit(0.0)),
        "model_age_kilometer_mean": F.coalesce(pick("__g_kmean", "__m_kmean"), F.col("__b_kmean"),
                                               lit(glob["kmean"])),
        "model_age_kilometer_std": F.coalesce(pick("__g_kstd", "__m_kstd"), F.col("__b_kstd"), lit(glob["kstd"]),
                                              F.lit(0.0)),
    })
    out = out.withColumns({
        "power_minus_model_age_power_mean": p - F.col("model_age_power_mean"),
        "power_ratio_model_age_power_mean": safe_div(p, F.col("model_age_power_mean") + F.lit(C.RATIO_EPS)),
        "kilometer_minus_model_age_kilometer_mean": k - F.col("model_age_kilometer_mean"),
        "kilometer_ratio_model_age_kilometer_mean": safe_div(
            k, F.col("model_age_kilometer_mean") + F.lit(C.RATIO_EPS)),
    })
    return out.drop(*[c for c in out.columns if c.startswith("__g_") or c.startswith("__m_")
                      or c.startswith("__b_")])
