"""Query catalog: one Spark plan per inventory operator over the `listings`
fixture, each with the equivalent DuckDB SQL for the oracle check.

Every query reads the driver tables through `fixture.listings`, so its work
grows with the data. Double outputs are rounded to 9 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.dates import age_bin, power_bin
from ..operators import clean, features, validate
from ..sources import fixture
from . import feature_frame
from . import oracle_sql as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        fn.query_name = name
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every floating column; cast small integers to bigint so both
    engines report the same types."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return fixture.listings(spark, sf)


def base(spark: SparkSession, sf: str, use_power_bin: bool = False) -> DataFrame:
    """Row-local F1 + D2 over the fixture (no keyed statistics)."""
    return features.add_date_features(features.normalize_numeric_columns(listings(spark, sf), use_power_bin))


def r(x: str, d: int = 9) -> str:
    return f"(round(CAST({x} AS DOUBLE), {d}) + 0.0)"


# ------------------------------------------------------------------- V / C
@query("range_report", O.with_ctes() + """
SELECT check_name, bad_count, row_count, (round(bad_rate, 9) + 0.0) AS bad_rate, failed FROM (
  SELECT check_name, bad_count, row_count, CAST(bad_count AS DOUBLE) / row_count AS bad_rate,
         CASE WHEN check_name = 'price' THEN bad_count > 0
              ELSE CAST(bad_count AS DOUBLE) / row_count > 0.001 END AS failed
  FROM (
    SELECT 'price' AS check_name, CAST(sum(CASE WHEN price < 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad_count, count(*) AS row_count FROM listings
    UNION ALL SELECT 'kilometer', CAST(sum(CASE WHEN kilometer < 0 OR kilometer > 15 THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM listings
    UNION ALL SELECT 'bodyType', CAST(sum(CASE WHEN bodyType < 0 OR bodyType > 7 THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM listings
    UNION ALL SELECT 'fuelType', CAST(sum(CASE WHEN fuelType < 0 OR fuelType > 6 THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM listings
    UNION ALL SELECT 'gearbox', CAST(sum(CASE WHEN gearbox < 0 OR gearbox > 1 THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM listings
    UNION ALL SELECT 'regionCode', CAST(sum(CASE WHEN regionCode < 0 OR regionCode > 100000 THEN 1 ELSE 0 END) AS BIGINT), count(*) FROM listings
  ) t) u
""")
def q_range_report(spark, sf):
    """V2/V3: one aggregate job, one row per range check."""
    rep = validate.range_report(listings(spark, sf))
    return rounded(rep.withColumnRenamed("check", "check_name"))


_CLEAN_COLS = ["SaleID", "name", "regDate", "creatDate", "model", "brand", "bodyType", "fuelType", "gearbox",
               "power", "kilometer", "notRepairedDamage", "regionCode", "seller", "offerType", "price",
               "v_0", "v_1", "v_2", "v_3", "v_4"]


def _int_sql(c):
    d = f"TRY_CAST({c} AS DOUBLE)"
    return f"CASE WHEN {d} = floor({d}) THEN CAST({d} AS BIGINT) END AS {c}"


@query("clean_tokens", O.with_ctes() + f"""
SELECT {_int_sql('SaleID')}, {_int_sql('name')}, {_int_sql('regDate')}, {_int_sql('creatDate')},
       {r('model')} AS model, {_int_sql('brand')}, {r('bodyType')} AS bodyType, {r('fuelType')} AS fuelType,
       {r('gearbox')} AS gearbox, {r('power')} AS power, {r('kilometer')} AS kilometer,
       CASE WHEN trim(notRepairedDamage) IN ('-', '') THEN NULL ELSE trim(notRepairedDamage) END AS notRepairedDamage,
       {_int_sql('regionCode')}, {_int_sql('seller')}, {_int_sql('offerType')}, {r('price')} AS price,
       {r('v_0')} AS v_0, {r('v_1')} AS v_1, {r('v_2')} AS v_2, {r('v_3')} AS v_3, {r('v_4')} AS v_4
FROM listings
""")
def q_clean_tokens(spark, sf):
    """C1 -> C2 -> C3 (the C5 composition without the raising validator)."""
    df = listings(spark, sf).select(*_CLEAN_COLS)
    return rounded(clean.clean_dataframe(df, "train", validate=False))


@query("category_keys", O.with_ctes() + """
SELECT SaleID, """ + ", ".join(f"{O.cat_text(c)} AS {c}" for c in C.CATEGORICAL_COLUMNS) + """
FROM listings
""")
def q_category_keys(spark, sf):
    """C6 (+C8 drop list applied to everything but the id)."""
    df = clean.normalize_categorical_columns(listings(spark, sf))
    return df.select(C.ID_COL, *C.CATEGORICAL_COLUMNS)


# ------------------------------------------------------------------- D
_DATE_COLS = ["reg_year", "reg_month", "reg_day", "reg_weekday", "create_year", "create_month",
              "create_day", "create_weekday", "car_age_days"]


@query("date_parts", O.with_ctes(O.base_cte()) + """
SELECT SaleID, """ + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _DATE_COLS) + """,
       (round(car_age_years, 9) + 0.0) AS car_age_years
FROM base
""")
def q_date_parts(spark, sf):
    """D1 + D2: compact dates parsed (illegal -> NULL), parts, age."""
    return rounded(base(spark, sf).select(C.ID_COL, *_DATE_COLS, "car_age_years"))


@query("age_bin_counts", O.with_ctes(O.base_cte()) + f"""
SELECT age_bin, count(*) AS n,
       CAST(sum(CASE WHEN {O.clip0('car_age_years')} <= 1 THEN 1 ELSE 0 END) AS BIGINT) AS nearly_new_1y,
       CAST(sum(CASE WHEN {O.clip0('car_age_years')} <= 3 THEN 1 ELSE 0 END) AS BIGINT) AS nearly_new_3y,
       round(avg({O.clip0('CAST(car_age_days AS DOUBLE)')} / 30.4), 9) + 0.0 AS mean_age_months
FROM (SELECT *, {O.age_bin('car_age_years')} AS age_bin FROM base) t
GROUP BY age_bin
""")
def q_age_bin_counts(spark, sf):
    """D3 + D4 summarised per age bin."""
    df = features.add_age_detail_features(base(spark, sf)).withColumn("age_bin", age_bin("car_age_years"))
    out = df.groupBy("age_bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("is_nearly_new_1y").cast("bigint").alias("nearly_new_1y"),
        F.sum("is_nearly_new_3y").cast("bigint").alias("nearly_new_3y"),
        F.avg("car_age_months").alias("mean_age_months"))
    return rounded(out)


@query("power_bins", O.with_ctes(O.base_cte(power_bin_code_col=True)) + f"""
SELECT b.SaleID, {r('b.power')} AS power, CAST(b.power_outlier_flag AS BIGINT) AS power_outlier_flag,
       CAST(b.power_is_zero AS BIGINT) AS power_is_zero, {r('b.power_bin')} AS power_bin,
       {O.power_bin('l.power')} AS power_bin_label
FROM base b JOIN listings l ON b.SaleID = l.SaleID
""")
def q_power_bins(spark, sf):
    """F1 (flag before clip, clip, zero flag, bin code) + D5 labels."""
    df = listings(spark, sf).withColumn("power_bin_label", power_bin("power"))
    df = features.normalize_power_features(df, use_power_bin=True)
    return rounded(df.select(C.ID_COL, "power", "power_outlier_flag", "power_is_zero", "power_bin",
                             "power_bin_label"))


@query("model_frequency_bins", O.with_ctes() + f"""
SELECT SaleID, {O.freq_bin('cnt')} AS model_frequency_bin FROM (
  SELECT SaleID, count(*) OVER (PARTITION BY coalesce(trim(CAST(model AS VARCHAR)), '__MISSING__')) AS cnt
  FROM listings) t
""")
def q_model_frequency_bins(spark, sf):
    """Model row counts binned f1..f51_plus (missing model is a key)."""
    return features.add_model_frequency_bin(listings(spark, sf)).select(C.ID_COL, "model_frequency_bin")


_F2 = ["kilometer_per_year", "age_kilometer_interaction", "is_nearly_new_1y", "is_old_car_10y"]


@query("depreciation", O.with_ctes(O.base_cte()) + f"""
SELECT SaleID,
  {r(f"CASE WHEN {O.clip0('car_age_years')} > 0 THEN kilometer / {O.clip0('car_age_years')} END")} AS kilometer_per_year,
  {r(f"{O.clip0('car_age_years')} * kilometer")} AS age_kilometer_interaction,
  CASE WHEN car_age_years IS NULL THEN NULL WHEN {O.clip0('car_age_years')} <= 1 THEN 1.0 ELSE 0.0 END AS is_nearly_new_1y,
  CASE WHEN car_age_years IS NULL THEN NULL WHEN {O.clip0('car_age_years')} >= 10 THEN 1.0 ELSE 0.0 END AS is_old_car_10y
FROM base
""")
def q_depreciation(spark, sf):
    """mileage intensity and nullable age flags."""
    return rounded(features.add_depreciation_features(base(spark, sf)).select(C.ID_COL, *_F2))


_F3 = ["power_per_age_year", "power_per_age_year_sqrt", "power_age_product", "power_age_ratio",
       "log_power_per_age", "kilometer_per_age_year", "log_kilometer_per_age", "age_kilometer_product"]


def _f3_sql(src: str = "base") -> str:
    a = O.clip0("car_age_years")
    b = f"(coalesce({a}, 0.0) + 1.0)"
    return f"""
SELECT SaleID,
  {r(f"power / {b}")} AS power_per_age_year, {r(f"power / sqrt({b})")} AS power_per_age_year_sqrt,
  {r(f"power * {a}")} AS power_age_product, {r(f"power / {b}")} AS power_age_ratio,
  {r(f"ln(1 + {O.clip0('power')}) / {b}")} AS log_power_per_age,
  {r(f"kilometer / {b}")} AS kilometer_per_age_year,
  {r(f"ln(1 + {O.clip0('kilometer')}) / {b}")} AS log_kilometer_per_age,
  {r(f"{a} * kilometer")} AS age_kilometer_product
FROM {src}"""


@query("power_age", O.with_ctes(O.base_cte()) + _f3_sql())
def q_power_age(spark, sf):
    """power / mileage per age year, log and product forms."""
    return rounded(features.add_power_age_features(base(spark, sf)).select(C.ID_COL, *_F3))


# ------------------------------------------------------------------- F4 / G
def counts_cte(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, CAST(count(*) OVER (PARTITION BY name) AS DOUBLE) AS name_count,
            CAST(count(*) OVER (PARTITION BY brand) AS DOUBLE) AS brand_count,
            CAST(count(*) OVER (PARTITION BY regionCode) AS DOUBLE) AS regionCode_count,
            CAST(count(*) OVER (PARTITION BY model) AS DOUBLE) AS model_count
  FROM {src})"""


def g1_cte(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, avg(power) OVER (PARTITION BY brand) AS brand_power_mean,
            quantile_cont(power, 0.5) OVER (PARTITION BY brand) AS brand_power_median,
            avg(kilometer) OVER (PARTITION BY brand) AS brand_kilometer_mean,
            avg(power) OVER (PARTITION BY model) AS model_power_mean
  FROM {src})"""


_F4 = ["name_count", "brand_count", "regionCode_count", "model_count"]
_G1 = ["brand_power_mean", "brand_power_median", "brand_kilometer_mean", "model_power_mean"]


@query("count_encoding", O.with_ctes(O.base_cte(), counts_cte("base", "cnt")) + """
SELECT SaleID, name_count, brand_count, regionCode_count, model_count FROM cnt
""")
def q_count_encoding(spark, sf):
    """key frequencies (missing key counted), size-checked broadcast join-back."""
    return rounded(features.add_count_encoding(base(spark, sf)).select(C.ID_COL, *_F4))


@query("group_stats", O.with_ctes(O.base_cte(), g1_cte("base", "g1")) + f"""
SELECT SaleID, {', '.join(f"{r(c)} AS {c}" for c in _G1)} FROM g1
""")
def q_group_stats(spark, sf):
    """G1: brand power mean/median, brand mileage mean, model power mean."""
    return rounded(features.add_group_statistics(base(spark, sf)).select(C.ID_COL, *_G1))


def g2_cte(src: str, name: str, min_count: int = 20) -> str:
    ab = O.age_bin("car_age_years")
    use = f"model_age_count >= {float(min_count)}"
    return f"""{name}_k AS (
  SELECT *, CAST(model AS VARCHAR) || '|' || {ab} AS gkey FROM {src}),
{name}_s AS (
  SELECT *,
    CAST(count(*) OVER (PARTITION BY gkey) AS DOUBLE) AS model_age_count,
    quantile_cont(power, 0.5) OVER (PARTITION BY gkey) AS g_pmed, quantile_cont(kilometer, 0.5) OVER (PARTITION BY gkey) AS g_kmed,
    avg(power) OVER (PARTITION BY gkey) AS g_pmean, avg(kilometer) OVER (PARTITION BY gkey) AS g_kmean,
    stddev_samp(power) OVER (PARTITION BY gkey) AS g_pstd, stddev_samp(kilometer) OVER (PARTITION BY gkey) AS g_kstd,
    quantile_cont(power, 0.5) OVER (PARTITION BY model) AS m_pmed, quantile_cont(kilometer, 0.5) OVER (PARTITION BY model) AS m_kmed,
    avg(power) OVER (PARTITION BY model) AS m_pmean, avg(kilometer) OVER (PARTITION BY model) AS m_kmean,
    stddev_samp(power) OVER (PARTITION BY model) AS m_pstd, stddev_samp(kilometer) OVER (PARTITION BY model) AS m_kstd,
    avg(power) OVER (PARTITION BY brand) AS b_pmean, avg(kilometer) OVER (PARTITION BY brand) AS b_kmean,
    stddev_samp(power) OVER (PARTITION BY brand) AS b_pstd, stddev_samp(kilometer) OVER (PARTITION BY brand) AS b_kstd,
    quantile_cont(power, 0.5) OVER () AS a_pmed, quantile_cont(kilometer, 0.5) OVER () AS a_kmed,
    avg(power) OVER () AS a_pmean, avg(kilometer) OVER () AS a_kmean,
    stddev_samp(power) OVER () AS a_pstd, stddev_samp(kilometer) OVER () AS a_kstd
  FROM {name}_k),
{name}_b AS (
  SELECT * EXCLUDE (gkey, g_pmed, g_kmed, g_pmean, g_kmean, g_pstd, g_kstd, m_pmed, m_kmed, m_pmean, m_kmean,
                    m_pstd, m_kstd, b_pmean, b_kmean, b_pstd, b_kstd, a_pmed, a_kmed, a_pmean, a_kmean, a_pstd, a_kstd),
    coalesce(CASE WHEN model_count = 0 THEN NULL ELSE model_age_count / model_count END, 0.0) AS model_age_count_ratio,
    coalesce(CASE WHEN {use} THEN g_pmed ELSE m_pmed END, a_pmed) AS model_age_power_median,
    coalesce(CASE WHEN {use} THEN g_kmed ELSE m_kmed END, a_kmed) AS model_age_kilometer_median,
    coalesce(CASE WHEN {use} THEN g_pmean ELSE m_pmean END, b_pmean, a_pmean) AS model_age_power_mean,
    coalesce(CASE WHEN {use} THEN g_pstd ELSE m_pstd END, b_pstd, a_pstd, 0.0) AS model_age_power_std,
    coalesce(CASE WHEN {use} THEN g_kmean ELSE m_kmean END, b_kmean, a_kmean) AS model_age_kilometer_mean,
    coalesce(CASE WHEN {use} THEN g_kstd ELSE m_kstd END, b_kstd, a_kstd, 0.0) AS model_age_kilometer_std
  FROM {name}_s),
{name} AS (
  SELECT *, power - model_age_power_mean AS power_minus_model_age_power_mean,
    {O.sdiv('power', 'model_age_power_mean + 1e-6')} AS power_ratio_model_age_power_mean,
    kilometer - model_age_kilometer_mean AS kilometer_minus_model_age_kilometer_mean,
    {O.sdiv('kilometer', 'model_age_kilometer_mean + 1e-6')} AS kilometer_ratio_model_age_kilometer_mean
  FROM {name}_b)"""


_G2 = ["model_age_count", "model_age_count_ratio", "model_age_power_median", "model_age_kilometer_median",
       "model_age_power_mean", "model_age_power_std", "model_age_kilometer_mean", "model_age_kilometer_std",
       "power_minus_model_age_power_mean", "power_ratio_model_age_power_mean",
       "kilometer_minus_model_age_kilometer_mean", "kilometer_ratio_model_age_kilometer_mean"]


@query("model_age_stats", O.with_ctes(O.base_cte(), counts_cte("base", "cnt"), g2_cte("cnt", "g2")) + f"""
SELECT SaleID, {', '.join(f"{r(c)} AS {c}" for c in _G2)} FROM g2
""")
def q_model_age_stats(spark, sf):
    """Model x age-bin support and back-off peer statistics."""
    df = features.add_count_encoding(base(spark, sf), ["model"])
    return rounded(features.add_model_age_group_stats(df, 20).select(C.ID_COL, *_G2))


def f6_cte(src: str, name: str) -> str:
    return f"""{name} AS (
  SELECT *, power - brand_power_mean AS power_minus_brand_power_mean,
    {O.sdiv('power', 'brand_power_mean + 1e-6')} AS power_ratio_brand_power_mean,
    kilometer - brand_kilometer_mean AS kilometer_minus_brand_kilometer_mean,
    {O.sdiv('kilometer', 'brand_kilometer_mean + 1e-6')} AS kilometer_ratio_brand_kilometer_mean,
    avg(car_age_years) OVER (PARTITION BY brand) AS brand_car_age_years_mean,
    car_age_years - avg(car_age_years) OVER (PARTITION BY brand) AS car_age_minus_brand_age_mean
  FROM {src})"""


_F6 = ["power_minus_brand_power_mean", "power_ratio_brand_power_mean", "kilometer_minus_brand_kilometer_mean",
       "kilometer_ratio_brand_kilometer_mean", "brand_car_age_years_mean", "car_age_minus_brand_age_mean"]


@query("brand_relative", O.with_ctes(O.base_cte(), g1_cte("base", "g1"), f6_cte("g1", "f6")) + f"""
SELECT SaleID, {', '.join(f"{r(c)} AS {c}" for c in _F6)} FROM f6
""")
def q_brand_relative(spark, sf):
    """F5 + F6 (+G3): power/mileage/age against brand peers."""
    df = features.add_brand_relative_features(features.add_group_statistics(base(spark, sf)))
    df = features.add_interaction_features(df)
    return rounded(df.select(C.ID_COL, *_F6))


# ------------------------------------------------------------------- F0 / P
_LISTING_OUT = ["SaleID", "name", "regDate", "creatDate", "seller", "offerType", "kilometer",
                "v_0", "v_1", "v_2", "v_3", "v_4"]


def _f0_select(extra: list[str], extra_ints: tuple[str, ...] = ()) -> str:
    cats = ", ".join(f"{O.cat_text(c)} AS {c}" for c in C.CATEGORICAL_COLUMNS)
    nums = ", ".join(f"{r(c)} AS {c}" for c in ["power", "kilometer", "v_0", "v_1", "v_2", "v_3", "v_4"] + extra)
    ints = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in
                     ["power_outlier_flag", "power_is_zero"] + _DATE_COLS + list(extra_ints))
    return f"SaleID, name, regDate, creatDate, {cats}, {nums}, {ints}, {r('car_age_years')} AS car_age_years"


@query("feature_frame", O.with_ctes(
    "train AS (SELECT * EXCLUDE (is_train) FROM listings WHERE is_train)",
    O.base_cte("train"), counts_cte("base", "cnt"), g1_cte("cnt", "g1")) + f"""
SELECT {_f0_select(_F4 + _G1)}, {r('price')} AS price FROM g1
""")
def q_feature_frame(spark, sf):
    """F0 + P2: default feature steps on the train table alone (statistics per
    table), categorical keys normalised at the end."""
    train, _ = fixture.split_train_test(listings(spark, sf))
    df = feature_frame.build_train_features(train)
    return rounded(df.drop("seller", "offerType"))


_P1_EXTRA = _F4 + _G1 + _F3 + ["car_age_months"] + _G2 + _F6
_P1_INTS = ("is_nearly_new_1y", "is_nearly_new_3y")


def _p1_sql() -> str:
    a = O.clip0("car_age_years")
    d4 = f"""d4 AS (SELECT *, {O.clip0('CAST(car_age_days AS DOUBLE)')} / 30.4 AS car_age_months,
        CASE WHEN {a} <= 1 THEN 1 ELSE 0 END AS is_nearly_new_1y,
        CASE WHEN {a} <= 3 THEN 1 ELSE 0 END AS is_nearly_new_3y FROM f3)"""
    b = f"(coalesce({a}, 0.0) + 1.0)"
    f3 = f"""f3 AS (SELECT *, power / {b} AS power_per_age_year, power / sqrt({b}) AS power_per_age_year_sqrt,
        power * {a} AS power_age_product, power / {b} AS power_age_ratio,
        ln(1 + {O.clip0('power')}) / {b} AS log_power_per_age, kilometer / {b} AS kilometer_per_age_year,
        ln(1 + {O.clip0('kilometer')}) / {b} AS log_kilometer_per_age, {a} * kilometer AS age_kilometer_product
      FROM f6)"""
    full = ("full_rows AS (SELECT * EXCLUDE (is_train, price), CASE WHEN is_train THEN 1 ELSE 0 END AS __is_train__, "
            "CASE WHEN is_train THEN price END AS price FROM listings)")
    cols = _f0_select(_P1_EXTRA, _P1_INTS).replace("SaleID, name, regDate, creatDate, ", "SaleID, ")
    return O.with_ctes(full, O.base_cte("full_rows", power_bin_code_col=True), counts_cte("base", "cnt"),
                       g1_cte("cnt", "g1"), f6_cte("g1", "f6"), f3, d4, g2_cte("d4", "g2")) + f"""
SELECT {cols}, {r('power_bin')} AS power_bin, CAST(__is_train__ AS BIGINT) AS __is_train__, {r('price')} AS price
FROM g2"""


@query("transductive_features", _p1_sql())
def q_transductive_features(spark, sf):
    """Train and test unioned, every statistic over both, all feature
    switches on, unused columns dropped."""
    train, test = fixture.split_train_test(listings(spark, sf))
    steps = ["group_stats", "interactions", "brand_relative", "power_age", "age_detail", "model_age_stats"]
    prepared = feature_frame.prepare_features(train, test, steps, power_bin=True)
    return rounded(prepared.frame)


# ===================================================================== K / D7
from ..config import Encodings  # noqa: E402
from ..operators import encode, folds  # noqa: E402
from ..operators.ranking import price_quantile_bin  # noqa: E402


def _md5(seed) -> str:
    return f"md5(CAST(SaleID AS VARCHAR) || ':{seed}')"


def _train_sql(src: str = "base") -> str:
    return f"SELECT * FROM {src} WHERE is_train"


@query("price_quantile_bins", O.with_ctes(
    "tr AS (SELECT SaleID, price FROM listings WHERE is_train)") + """
SELECT SaleID, 'Q' || CAST(greatest(CAST(ceil((rk - 1) * 5.0 / (n - 1)) AS BIGINT) - 1, 0) + 1 AS VARCHAR) AS price_bin
FROM (SELECT SaleID, row_number() OVER (ORDER BY price, SaleID) AS rk, count(*) OVER () AS n FROM tr) t
""")
def q_price_quantile_bins(spark, sf):
    """D7 + R3: exact "first"-tie ranks by (price, id) without a
    single-partition window, cut into 5 equal-count bins."""
    train, _ = fixture.split_train_test(listings(spark, sf))
    return price_quantile_bin(train.select(C.ID_COL, C.TARGET_COL), C.TARGET_COL, C.ID_COL, 5).select(
        C.ID_COL, "price_bin")


@query("sample_rows", O.with_ctes() + f"""
SELECT SaleID, round(price, 9) + 0.0 AS price FROM (
  SELECT SaleID, price, row_number() OVER (ORDER BY {_md5(7)}, SaleID) AS rk FROM listings) t
WHERE rk <= 1000
""")
def q_sample_rows(spark, sf):
    """K1: exactly 1000 rows, deterministic in (id, seed) (the sample size is
    the operator's parameter, not a cap on the check)."""
    return rounded(folds.sample_rows(listings(spark, sf).select(C.ID_COL, C.TARGET_COL), 1000, seed=7))


@query("train_valid_split", O.with_ctes() + f"""
SELECT SaleID, CASE WHEN rk <= CAST(ceil(n * 0.2) AS BIGINT) THEN 'valid' ELSE 'train' END AS split FROM (
  SELECT SaleID, row_number() OVER (ORDER BY {_md5(42)}, SaleID) AS rk, count(*) OVER () AS n
  FROM listings WHERE is_train) t
""")
def q_train_valid_split(spark, sf):
    """K2: 20 % validation by hash rank (ceil of the fraction)."""
    train, _ = fixture.split_train_test(listings(spark, sf))
    return folds.train_valid_split(train.select(C.ID_COL), 0.2, seed=42).select(C.ID_COL, "split")


def _kfold_cte(src: str, name: str, k: int = 5, seed: int = 42) -> str:
    return (f"{name} AS (SELECT *, CAST((row_number() OVER (ORDER BY {_md5(seed)}, SaleID) - 1) % {k} + 1 AS INTEGER)"
            f" AS fold FROM {src})")


@query("kfold_assign", O.with_ctes("tr AS (SELECT SaleID FROM listings WHERE is_train)", _kfold_cte("tr", "kf")) + """
SELECT SaleID, CAST(fold AS BIGINT) AS fold FROM kf
""")
def q_kfold_assign(spark, sf):
    """K3: shuffled 5-fold assignment (round-robin in hash order)."""
    train, _ = fixture.split_train_test(listings(spark, sf))
    return rounded(folds.kfold_assign(train.select(C.ID_COL), 5, 42).select(C.ID_COL, "fold"))


def _strat_label_ctes(src: str, k: int = 5, price_bins: int = 5) -> list[str]:
    """K5 + K6 in SQL, directly on rows (brute force over windows)."""
    pb = (f"CASE WHEN price IS NULL THEN '__PRICE_MISSING__' ELSE 'Q' || CAST(greatest(CAST(ceil((rk - 1) * "
          f"{float(price_bins)} / greatest(n - 1, 1)) AS BIGINT) - 1, 0) + 1 AS VARCHAR) END")
    lv0 = f"""sl0 AS (
  SELECT SaleID, pbin, abin, fbin, pbin || '|' || abin || '|' || fbin AS lbl, pbin || '|' || abin AS pa FROM (
    SELECT SaleID, {pb} AS pbin, {O.age_bin('car_age_years')} AS abin, {O.freq_bin('mcnt')} AS fbin FROM (
      SELECT SaleID, price, car_age_years,
             row_number() OVER (PARTITION BY price IS NULL ORDER BY price, SaleID) AS rk,
             count(price) OVER () AS n,
             count(*) OVER (PARTITION BY coalesce(trim(CAST(model AS VARCHAR)), '__MISSING__')) AS mcnt
      FROM {src}) a) b)"""
    ctes = [lv0]
    prev = "sl0"
    for i, fb in enumerate(["pa", "pbin", "abin"], start=1):
        ctes.append(f"""sl{i} AS (
  SELECT * EXCLUDE (lbl, rare_any), CASE WHEN rare_any THEN {fb} ELSE lbl END AS lbl FROM (
    SELECT *, bool_or(rare) OVER (PARTITION BY {fb}) AS rare_any FROM (
      SELECT *, count(*) OVER (PARTITION BY lbl) < {k} AS rare FROM {prev}) x) y)""".replace(
            "SELECT * EXCLUDE (lbl, rare_any)", "SELECT * EXCLUDE (lbl, rare_any, rare)"))
        prev = f"sl{i}"
    ctes.append(f"""sl4 AS (
  SELECT * EXCLUDE (lbl), CASE WHEN count(*) OVER (PARTITION BY lbl) < {k} THEN '__ALL__' ELSE lbl END AS lbl
  FROM {prev})""")
    ctes.append(f"""strat AS (
  SELECT SaleID, CASE WHEN bool_or(c < {k}) OVER () THEN '__ALL__' ELSE lbl END AS strat_label FROM (
    SELECT *, count(*) OVER (PARTITION BY lbl) AS c FROM sl4) z)""")
    return ctes


@query("collapse_labels", O.with_ctes(O.base_cte(), "tr AS (SELECT * FROM base WHERE is_train)",
                                      *_strat_label_ctes("tr")) + """
SELECT strat_label, count(*) AS n FROM strat GROUP BY strat_label
""")
def q_collapse_labels(spark, sf):
    """K5 + K6: price|age|model-frequency labels with rare-label collapse,
    reported as label sizes."""
    train = base(spark, sf).where(F.col("is_train"))
    lab = folds.stratification_labels(train.select(C.ID_COL, C.TARGET_COL, "car_age_years", "model"), 5, 5)
    return lab.groupBy("strat_label").agg(F.count(F.lit(1)).alias("n"))


@query("stratified_assign", O.with_ctes(O.base_cte(), "tr AS (SELECT * FROM base WHERE is_train)",
                                        *_strat_label_ctes("tr"),
                                        "rep AS (SELECT * FROM (VALUES (1), (2), (3)) v(repeat))") + """
SELECT SaleID, CAST(repeat AS BIGINT) AS repeat, strat_label,
       CAST((row_number() OVER (PARTITION BY repeat, strat_label
             ORDER BY md5(CAST(SaleID AS VARCHAR) || ':' || CAST(41 + repeat AS VARCHAR)), SaleID) - 1) % 5 + 1 AS BIGINT) AS fold
FROM strat, rep
""")
def q_stratified_assign(spark, sf):
    """K4 + K5 + K6: 5 folds x 3 repeats, stratified on collapsed labels,
    ranks inside labels via the range-partitioned global rank."""
    train = base(spark, sf).where(F.col("is_train"))
    plan = folds.stratified_assign(train, n_splits=5, repeats=3, seed=42, price_bins=5)
    return rounded(plan.select(C.ID_COL, "repeat", "strat_label", "fold"))


# ===================================================================== T
SMOOTH = 20.0


def enc_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Row-local listing features with category keys normalised (the key
    space the trainer encodes), train flag kept."""
    return clean.normalize_categorical_columns(base(spark, sf))


def _folded_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The train rows with the columns that encodings read and their fold. What comes before
    the folds, and the folds, are written once: the steps that follow pass over both more
    than once."""
    train = enc_frame(spark, sf).where(F.col("is_train")).select(C.ID_COL, C.TARGET_COL, "brand", "model", "power", "car_age_years")
    return saved(folds.kfold_assign(saved(train, "train-rows"), 5, 42), "folded-rows")


def _enc_rows_cte(name: str = "er", target: str = "price") -> str:
    cats = ", ".join(f"{O.cat_text(c)} AS {c}" for c in ("brand", "model"))
    return (f"{name} AS (SELECT SaleID, is_train, {cats}, power, car_age_years, {target} AS t "
            f"FROM base)")


_SQL_KEYS = {
    "brand": "brand",
    "model": "model",
    "brand_age": f"brand || '|' || {O.age_bin('car_age_years')}",
    "model_age": f"model || '|' || {O.age_bin('car_age_years')}",
    "model_power_age": f"model || '|' || {O.power_bin('power')} || '|' || {O.age_bin('car_age_years')}",
    "power_bin": O.power_bin("power"),
    "power_age": f"{O.power_bin('power')} || '|' || {O.age_bin('car_age_years')}",
}


def _enc_stat_ctes(fit: str, apply: str, keys: list[str]) -> list[str]:
    """Per apply fold g: global mean and key statistics of fit rows with
    fold <> g (g = 0 excludes nothing). Brute force, for the oracle."""
    ctes = [f"ag AS (SELECT DISTINCT afold FROM {apply})",
            f"gm AS (SELECT ag.afold, avg(f.t) AS gmean FROM ag JOIN {fit} f ON f.fold <> ag.afold GROUP BY ag.afold)"]
    for k in keys:
        e = _SQL_KEYS[k].replace("car_age_years", "f.car_age_years").replace("power)", "f.power)")
        e = _sql_on(k, "f")
        ctes.append(f"ks_{k} AS (SELECT ag.afold, {e} AS kval, sum(f.t) AS s, count(f.t) AS n, count(*) AS r "
                    f"FROM ag JOIN {fit} f ON f.fold <> ag.afold GROUP BY 1, 2)")
    return ctes


def _sql_on(k: str, alias: str) -> str:
    """Key expression with columns qualified by `alias`."""
    a = alias
    ab = O.age_bin(f"{a}.car_age_years")
    pb = O.power_bin(f"{a}.power")
    return {
        "brand": f"{a}.brand", "model": f"{a}.model",
        "brand_age": f"{a}.brand || '|' || {ab}", "model_age": f"{a}.model || '|' || {ab}",
        "model_power_age": f"{a}.model || '|' || {pb} || '|' || {ab}",
        "power_bin": pb, "power_age": f"{pb} || '|' || {ab}",
    }[k]


def _sm(k: str) -> str:
    return f"(CASE WHEN coalesce(ks_{k}.n, 0) > 0 THEN (ks_{k}.s + gm.gmean * {SMOOTH}) / (ks_{k}.n + {SMOOTH}) ELSE gm.gmean END)"


def _enc_joins(keys: list[str], apply_alias: str = "a") -> str:
    js = ["JOIN gm ON gm.afold = a.afold"]
    for k in keys:
        js.append(f"LEFT JOIN ks_{k} ON ks_{k}.afold = a.afold AND ks_{k}.kval = {_sql_on(k, apply_alias)}")
    return "\n".join(js)


def _enc_exprs(min_count: int = 20) -> dict[str, str]:
    mob = f"(CASE WHEN coalesce(ks_model.r, 0) >= {min_count} THEN {_sm('model')} ELSE {_sm('brand')} END)"
    return {
        "brand_target_mean": _sm("brand"),
        "brand_age_target_mean": _sm("brand_age"),
        "model_target_mean": _sm("model"),
        "model_backoff_target_mean": mob,
        "model_power_age_backoff_target_mean":
            f"(CASE WHEN coalesce(ks_model_power_age.n, 0) >= {min_count} THEN {_sm('model_power_age')} ELSE {mob} END)",
        "model_low_freq_flag": f"(CASE WHEN coalesce(ks_model.r, 0) < {min_count} THEN 1.0 ELSE 0.0 END)",
        "model_age_target_mean":
            f"(CASE WHEN coalesce(ks_model_age.n, 0) >= {min_count} THEN {_sm('model_age')} ELSE {mob} END)",
        "power_age_bin_target_mean":
            f"(CASE WHEN coalesce(ks_power_age.n, 0) >= {min_count} THEN {_sm('power_age')} ELSE {_sm('power_bin')} END)",
    }


_KEYS_FOR = {
    "brand_target_mean": ["brand"], "brand_age_target_mean": ["brand_age"], "model_target_mean": ["model"],
    "model_backoff_target_mean": ["model", "brand"],
    "model_power_age_backoff_target_mean": ["model", "brand", "model_power_age"],
    "model_low_freq_flag": ["model"], "model_age_target_mean": ["model", "brand", "model_age"],
    "power_age_bin_target_mean": ["power_bin", "power_age"],
}


def _cv_enc_sql(cols: list[str], target: str, fit_roles: bool = False) -> str:
    """Out-of-fold encodings on train rows with k-fold folds: validation rows
    use their own fold; with `fit_roles`, fit rows of every fold too."""
    keys = sorted({k for c in cols for k in _KEYS_FOR[c]})
    apply = ("ap AS (SELECT kf.*, g.fold AS afold, CASE WHEN kf.fold = g.fold THEN 'valid' ELSE 'fit' END AS role "
             "FROM kf, (SELECT DISTINCT fold FROM kf) g)") if fit_roles else \
        "ap AS (SELECT kf.*, kf.fold AS afold, 'valid' AS role FROM kf)"
    ex = _enc_exprs()
    sel = ", ".join(f"{r(ex[c])} AS {c}" for c in cols)
    return O.with_ctes(O.base_cte(), _enc_rows_cte("er", target), "tr AS (SELECT * FROM er WHERE is_train)",
                       _kfold_cte("tr", "kf"), apply, *_enc_stat_ctes("kf", "ap", keys)) + f"""
SELECT a.SaleID, CAST(a.afold AS BIGINT) AS fold, a.role, {sel}
FROM ap a
{_enc_joins(keys)}"""


def _cv_enc(spark, sf, outputs: list[str], target_mode: str = "log1p", fit_roles: bool = False) -> DataFrame:
    """Spark side: one stacked aggregation for all keys and folds, applied to
    validation rows (own fold) and optionally to every fold's fit rows."""
    from ..functions.targets import transform_target
    rows = _folded_rows(spark, sf)
    stats = encode.fit_stats(rows, transform_target(F.col(C.TARGET_COL), target_mode), encode.keys_for(outputs), "fold")
    if fit_roles:
        apply = rows.withColumn("afold", F.explode(F.sequence(F.lit(1), F.lit(5)))).withColumn(
            "role", F.when(F.col("fold") == F.col("afold"), "valid").otherwise("fit"))
    else:
        apply = rows.withColumn("afold", F.col("fold")).withColumn("role", F.lit("valid"))
    out = encode.apply_encodings(apply, stats, Encodings(tuple(outputs)), F.col("afold"))
    return rounded(out.select(C.ID_COL, F.col("afold").alias("fold"), "role", *outputs))


@query("te_brand_age", _cv_enc_sql(["brand_age_target_mean"], "ln(1 + " + O.clip0("price") + ")"))
def q_te_brand_age(spark, sf):
    """Brand x age-bin encoding of validation rows from the other folds (log1p target)."""
    return _cv_enc(spark, sf, ["brand_age_target_mean"])


@query("te_model_age", _cv_enc_sql(["model_age_target_mean", "power_age_bin_target_mean"],
                                   "ln(1 + " + O.clip0("price") + ")"))
def q_te_model_age(spark, sf):
    """T11 + T12: model x age with model/brand back-off, power x age with power-bin back-off."""
    return _cv_enc(spark, sf, ["model_age_target_mean", "power_age_bin_target_mean"])


@query("te_model_power_age", _cv_enc_sql(["model_backoff_target_mean", "model_power_age_backoff_target_mean"],
                                         "ln(1 + " + O.clip0("price") + ")"))
def q_te_model_power_age(spark, sf):
    """T7 + T8: model encoding with brand back-off, model x power x age on top."""
    return _cv_enc(spark, sf, ["model_backoff_target_mean", "model_power_age_backoff_target_mean"])


@query("low_freq_flag", _cv_enc_sql(["model_low_freq_flag"], "ln(1 + " + O.clip0("price") + ")"))
def q_low_freq_flag(spark, sf):
    """1.0 when the model has fewer than 20 fit rows."""
    return _cv_enc(spark, sf, ["model_low_freq_flag"])


_ALL_COLS = list(_KEYS_FOR)


@query("te_all", _cv_enc_sql(_ALL_COLS, "ln(1 + " + O.clip0("price") + ")", fit_roles=True))
def q_te_all(spark, sf):
    """T13 + T14: all eight encodings for every fold: validation rows from the
    other folds, fit rows self-included (trainer semantics)."""
    return _cv_enc(spark, sf, _ALL_COLS, fit_roles=True)


def _strict_sql(cols: list[str]) -> str:
    """By brute force: for each pair (outer fold, own fold) the statistics of the rows in neither."""
    keys = sorted({k for c in cols for k in _KEYS_FOR[c]})
    ctes = ["ag AS (SELECT DISTINCT afold, g, h FROM ap)",
            "gm AS (SELECT ag.afold, avg(f.t) AS gmean FROM ag JOIN kf f ON f.fold <> ag.g AND f.fold <> ag.h GROUP BY ag.afold)"]
    for k in keys:
        ctes.append(f"ks_{k} AS (SELECT ag.afold, {_sql_on(k, 'f')} AS kval, sum(f.t) AS s, count(f.t) AS n, count(*) AS r "
                    f"FROM ag JOIN kf f ON f.fold <> ag.g AND f.fold <> ag.h GROUP BY 1, 2)")
    ex = _enc_exprs()
    return O.with_ctes(O.base_cte(), _enc_rows_cte("er", "ln(1 + " + O.clip0("price") + ")"), "tr AS (SELECT * FROM er WHERE is_train)", _kfold_cte("tr", "kf"),
                       "ap AS (SELECT kf.*, g.fold AS g, kf.fold AS h, g.fold * 10 + kf.fold AS afold FROM kf, (SELECT DISTINCT fold FROM kf) g)", *ctes) + f"""
SELECT a.SaleID, CAST(a.g AS BIGINT) AS fold, CASE WHEN a.g = a.h THEN 'valid' ELSE 'fit' END AS role, {", ".join(f"{r(ex[c])} AS {c}" for c in cols)}
FROM ap a
{_enc_joins(keys)}"""


@query("te_strict", _strict_sql(_ALL_COLS))
def q_te_strict(spark, sf):
    """T14 strict: fit rows of every fold encoded without that fold and without their own."""
    rows = _folded_rows(spark, sf)
    stats = encode.fit_stats(rows, transform_target(F.col(C.TARGET_COL), "log1p"), encode.keys_for(_ALL_COLS), "fold")
    out = encode.strict_frames(rows, stats, Encodings(tuple(_ALL_COLS)), "fold", 5)
    return rounded(out.select(C.ID_COL, F.col("outer").alias("fold"), "role", *_ALL_COLS))


def _full_enc_sql(cols: list[str], target: str) -> str:
    keys = sorted({k for c in cols for k in _KEYS_FOR[c]})
    ex = _enc_exprs()
    sel = ", ".join(f"{r(ex[c])} AS {c}" for c in cols)
    return O.with_ctes(O.base_cte(), _enc_rows_cte("er", target),
                       "ft AS (SELECT *, 1 AS fold FROM er WHERE is_train)",
                       "ap AS (SELECT *, 0 AS afold FROM er WHERE NOT is_train)",
                       *_enc_stat_ctes("ft", "ap", keys)) + f"""
SELECT a.SaleID, {sel}
FROM ap a
{_enc_joins(keys)}"""


@query("te_backoff", _full_enc_sql(["model_backoff_target_mean", "model_power_age_backoff_target_mean"], "price"))
def q_te_backoff(spark, sf):
    """T3 + T7 + T8 full-train -> test (raw price)."""
    df = enc_frame(spark, sf)
    train, test = df.where(F.col("is_train")), df.where(~F.col("is_train"))
    cfg = Encodings(("model_backoff_target_mean", "model_power_age_backoff_target_mean"))
    stats = encode.fit_stats(train, F.col(C.TARGET_COL), encode.keys_for(cfg.outputs))
    out = encode.apply_encodings(test, stats, cfg)
    return rounded(out.select(C.ID_COL, *cfg.outputs))


def _proxy_sql(space_expr: str, suffix: str, oof: bool) -> str:
    ex = {"brand": _sm("brand"), "model": _sm("model")}
    if oof:
        ctes = ["tr AS (SELECT * FROM er WHERE is_train)", _kfold_cte("tr", "kf"),
                "ap AS (SELECT kf.*, kf.fold AS afold FROM kf)"]
        fit = "kf"
    else:
        ctes = ["kf AS (SELECT *, 1 AS fold FROM er WHERE is_train)",
                "ap AS (SELECT *, 0 AS afold FROM er WHERE NOT is_train)"]
        fit = "kf"
    return O.with_ctes(O.base_cte(), _enc_rows_cte("er", space_expr), *ctes,
                       *_enc_stat_ctes(fit, "ap", ["brand", "model"])) + f"""
SELECT a.SaleID, {r(ex['brand'])} AS brand{suffix}, {r(ex['model'])} AS model{suffix}
FROM ap a
{_enc_joins(['brand', 'model'])}"""


@query("smoothed_te", _proxy_sql("price", "_price_mean", oof=False))
def q_smoothed_te(spark, sf):
    """T2 + T5: full-train smoothed brand/model price means applied to test rows."""
    df = enc_frame(spark, sf)
    train, test = df.where(F.col("is_train")), df.where(~F.col("is_train"))
    enc = encode.fit_price_proxy_encoder(train, C.TARGET_COL, ("brand", "model"), SMOOTH)
    return rounded(enc.transform(test).select(C.ID_COL, "brand_price_mean", "model_price_mean"))


@query("oof_te", _proxy_sql("price", "_price_mean", oof=True))
def q_oof_te(spark, sf):
    """T4: strict out-of-fold brand/model price means for train rows (5 folds)."""
    rows = folds.kfold_assign(enc_frame(spark, sf).where(F.col("is_train")), 5, 42)
    out = encode.build_oof_price_proxy_features(rows, "fold", 5, C.TARGET_COL, ("brand", "model"), SMOOTH)
    return rounded(out.select(C.ID_COL, "brand_price_mean", "model_price_mean"))


_SQRT_PRICE = "sqrt(" + O.clip0("price") + ")"


@query("te_target_spaces", "SELECT * FROM (" + _proxy_sql(_SQRT_PRICE, "_sqrt_mean", oof=True) + ") UNION ALL SELECT * FROM ("
       + _proxy_sql(_SQRT_PRICE, "_sqrt_mean", oof=False) + ")")
def q_te_target_spaces(spark, sf):
    """T1 + T6: encodings fitted in sqrt(price) space, out-of-fold for train rows and
    from all train rows for test rows."""
    rows = folds.kfold_assign(enc_frame(spark, sf).where(F.col("is_train")), 5, 42)
    test = enc_frame(spark, sf).where(~F.col("is_train"))
    tr, te, _ = encode.build_oof_and_apply_price_proxy_features(
        rows, test, "fold", 5, C.TARGET_COL, ("brand", "model"), SMOOTH, "_sqrt_mean", "sqrt")
    cols = [C.ID_COL, "brand_sqrt_mean", "model_sqrt_mean"]
    return rounded(tr.select(*cols).unionByName(te.select(*cols)))


# ===================================================================== M / E
from ..functions.targets import inverse_target, transform_target  # noqa: E402
from ..operators import metrics, routing, weights  # noqa: E402

PRED_COLS = ["p_brand", "p_model", "p_median", "p_noisy"]


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction fixture for metric/blend operators: out-of-fold brand and
    model price means (5 folds), the train median, and a scaled price. All
    derived by Spark from the tables; fold kept for meta-CV."""
    rows = _folded_rows(spark, sf)
    oof = encode.build_oof_price_proxy_features(rows, "fold", 5, C.TARGET_COL, ("brand", "model"), SMOOTH)
    med = metrics.exact_quantiles(rows, C.TARGET_COL, [0.5])[0.5]
    return oof.select(
        C.ID_COL, C.TARGET_COL, "fold", "car_age_years",
        F.col("brand_price_mean").alias("p_brand"), F.col("model_price_mean").alias("p_model"),
        F.lit(med).alias("p_median"),
        (F.col(C.TARGET_COL) * (F.lit(0.8) + F.lit(0.4) * (F.col(C.ID_COL) % 7) / F.lit(6.0))).alias("p_noisy"))


def _pred_ctes() -> list[str]:
    ex = {"brand": _sm("brand"), "model": _sm("model")}
    return [O.base_cte(), _enc_rows_cte("er", "price"), "tr AS (SELECT * FROM er WHERE is_train)",
            _kfold_cte("tr", "kf"), "ap AS (SELECT kf.*, kf.fold AS afold FROM kf)",
            *_enc_stat_ctes("kf", "ap", ["brand", "model"]),
            f"""preds AS (
  SELECT a.SaleID, a.t AS price, a.fold, a.car_age_years, {ex['brand']} AS p_brand, {ex['model']} AS p_model,
         (SELECT quantile_cont(t, 0.5) FROM kf) AS p_median,
         a.t * (0.8 + 0.4 * (a.SaleID % 7) / 6.0) AS p_noisy
  FROM ap a
  {_enc_joins(['brand', 'model'])})"""]


@query("target_roundtrip", O.with_ctes(O.base_cte()) + f"""
SELECT SaleID, {r('ln(1 + ' + O.clip0('price') + ')')} AS t_log1p,
       {r(O.clip0('exp(ln(1 + ' + O.clip0('price') + ')) - 1'), 4)} AS back_log1p,
       {r('sqrt(' + O.clip0('price') + ')')} AS t_sqrt,
       {r('sqrt(' + O.clip0('price') + ') * sqrt(' + O.clip0('price') + ')', 4)} AS back_sqrt,
       {r('pow(' + O.clip0('price') + ', 0.75)')} AS t_pow075,
       {r('pow(pow(' + O.clip0('price') + ', 0.75), 1.0 / 0.75)', 4)} AS back_pow075,
       {r('price')} AS t_price
FROM base WHERE is_train
""")
def q_target_roundtrip(spark, sf):
    """M1: forward transforms and their clipped inverses."""
    df = base(spark, sf).where(F.col("is_train"))
    y = F.col(C.TARGET_COL)
    out = df.select(C.ID_COL, *[c for m in ("log1p", "sqrt", "pow075") for c in (
        F.round(transform_target(y, m), 9).alias(f"t_{m}"),
        F.round(inverse_target(transform_target(y, m), m), 4).alias(f"back_{m}"))],
        F.round(transform_target(y, "price"), 9).alias("t_price"))
    return rounded(out)


def _weights_sql(mode: str) -> str:
    if mode == "legacy":
        w = ("(CASE WHEN price >= (SELECT quantile_cont(price, 0.8) FROM tr) THEN 1.5 ELSE 1.0 END) * "
             "(CASE WHEN car_age_years <= 3 THEN 1.3 ELSE 1.0 END)")
        flag = "(price >= (SELECT quantile_cont(price, 0.8) FROM tr) OR coalesce(car_age_years <= 3, false))"
        src = "tr"
    else:
        pb = "'Q' || CAST(greatest(CAST(ceil((rk - 1) * 5.0 / (n - 1)) AS BIGINT) - 1, 0) + 1 AS VARCHAR)"
        key = f"{pb} || '|' || {O.age_bin('car_age_years')}"
        hit = f"({key} IN ('Q5|8y_plus', 'Q4|8y_plus', 'Q5|5_8y', 'Q3|8y_plus', 'Q5|3_5y'))"
        w = f"(CASE WHEN {hit} THEN 1.1 ELSE 1.0 END)"
        flag = hit
        src = "(SELECT *, row_number() OVER (ORDER BY price, SaleID) AS rk, count(*) OVER () AS n FROM tr) z"
    return O.with_ctes(O.base_cte(), "tr AS (SELECT * FROM base WHERE is_train)",
                       f"w AS (SELECT SaleID, {w} AS w0, {flag} AS flagged FROM {src})") + f"""
SELECT SaleID, {r('w0 / (SELECT avg(w0) FROM w)')} AS sample_weight FROM w"""


@query("weights_legacy", _weights_sql("legacy"))
def q_weights_legacy(spark, sf):
    """M2 legacy: x1.5 at/above the 0.8 price quantile, x1.3 for age <= 3, mean 1."""
    df = base(spark, sf).where(F.col("is_train"))
    out = weights.build_sample_weights(df, weights.WEIGHTINGS["legacy"])
    return rounded(out.select(C.ID_COL, "sample_weight"))


@query("weights_slice", _weights_sql("slice"))
def q_weights_slice(spark, sf):
    """M2 + M3 price_age_slice: x1.1 on the configured (price quintile, age bin) pairs."""
    df = base(spark, sf).where(F.col("is_train"))
    out = weights.build_sample_weights(df, weights.WEIGHTINGS["price_age_slice"])
    return rounded(out.select(C.ID_COL, "sample_weight"))


@query("weight_summary", _weights_sql("legacy").replace(
    f"SELECT SaleID, {r('w0 / (SELECT avg(w0) FROM w)')} AS sample_weight FROM w", """
SELECT CAST(sum(CASE WHEN flagged THEN 1 ELSE 0 END) AS BIGINT) AS weighted_sample_count,
       round(avg(sw), 9) + 0.0 AS weight_mean, round(min(sw), 9) + 0.0 AS weight_min,
       round(max(sw), 9) + 0.0 AS weight_max,
       CAST(sum(CASE WHEN abs(sw - 1.0) > 1e-12 THEN 1 ELSE 0 END) AS BIGINT) AS weight_non_default_count
FROM (SELECT *, w0 / (SELECT avg(w0) FROM w) AS sw FROM w) t"""))
def q_weight_summary(spark, sf):
    """M4: weighted rows, mean/min/max, rows with weight != 1 (after normalising)."""
    df = base(spark, sf).where(F.col("is_train"))
    out = weights.build_sample_weights(df, weights.WEIGHTINGS["legacy"])
    return rounded(weights.summarize_sample_weights(out))


def _route_sql_cols() -> str:
    thr = "(SELECT quantile_cont(price, 0.8) FROM preds)"
    ab = O.age_bin("car_age_years")
    return (f"coalesce(price >= {thr} AND {ab} IN ('5_8y', '8y_plus'), false) AS actual_segment, "
            f"coalesce(p_brand >= {thr} AND {ab} IN ('5_8y', '8y_plus'), false) AS routed")


@query("segment_routing", O.with_ctes(*_pred_ctes()) + f"""
SELECT SaleID, {_route_sql_cols()} FROM preds
""")
def q_segment_routing(spark, sf):
    """M8 + M9: actual segment (price) and routed rows (predicted price) at
    the 0.8 train-price quantile, ages 5 years and up."""
    return _routed(spark, sf).select(C.ID_COL, "actual_segment", "routed")


def _routed(spark, sf) -> DataFrame:
    p = predictions(spark, sf)
    thr = metrics.exact_quantiles(p, C.TARGET_COL, [0.8])[0.8]
    ab = age_bin("car_age_years")
    return p.withColumns({"actual_segment": routing.segment_mask(F.col(C.TARGET_COL), ab, thr),
                          "routed": routing.routing_mask(F.col("p_brand"), ab, thr)})


_FM_SQL = f"""
fm_rows AS (SELECT *, CASE WHEN routed THEN p_model ELSE p_brand END AS pred, p_brand AS global_pred
            FROM (SELECT *, {_route_sql_cols()} FROM preds) x),
fm AS (
  SELECT 1 AS repeat, fold, avg(abs(price - pred)) AS mae, avg(abs(price - global_pred)) AS global_mae,
    CAST(sum(CASE WHEN actual_segment THEN 1 ELSE 0 END) AS BIGINT) AS actual_segment_count,
    CAST(sum(CASE WHEN routed THEN 1 ELSE 0 END) AS BIGINT) AS routed_count,
    sum(CASE WHEN routed THEN 1 ELSE 0 END) / count(*) AS segment_coverage_rate,
    CAST(sum(CASE WHEN routed AND actual_segment THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN routed THEN 1 ELSE 0 END), 0) AS routing_precision,
    CAST(sum(CASE WHEN routed AND actual_segment THEN 1 ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN actual_segment THEN 1 ELSE 0 END), 0) AS routing_recall,
    avg(CASE WHEN actual_segment THEN abs(price - pred) END) AS segment_mae,
    avg(CASE WHEN actual_segment THEN abs(price - global_pred) END) AS global_segment_mae,
    avg(CASE WHEN NOT actual_segment THEN abs(price - pred) END) AS non_segment_mae,
    count(*) AS valid_rows
  FROM fm_rows GROUP BY fold)"""

_FM_COLS = ["mae", "global_mae", "segment_coverage_rate", "routing_precision", "routing_recall", "segment_mae",
            "global_segment_mae", "non_segment_mae"]


def _fold_metrics_spark(spark, sf) -> DataFrame:
    rows = _routed(spark, sf).withColumns({
        "pred": F.when(F.col("routed"), F.col("p_model")).otherwise(F.col("p_brand")),
        "global_pred": F.col("p_brand"), "repeat": F.lit(1)})
    return routing.fold_metrics(rows)


@query("fold_metrics", O.with_ctes(*_pred_ctes()) + "," + _FM_SQL + f"""
SELECT CAST(repeat AS BIGINT) AS repeat, CAST(fold AS BIGINT) AS fold, {', '.join(f"{r(c)} AS {c}" for c in _FM_COLS)},
       actual_segment_count, routed_count, valid_rows FROM fm
""")
def q_fold_metrics(spark, sf):
    """Per-fold MAE, global MAE, segment MAEs, routing precision/recall
    (routed rows take the model-mean prediction)."""
    return rounded(_fold_metrics_spark(spark, sf))


@query("cv_summary", O.with_ctes(*_pred_ctes()) + "," + _FM_SQL + f"""
SELECT {r('avg(mae)')} AS mae_mean, {r('stddev_pop(mae)')} AS mae_std, {r('avg(global_mae)')} AS global_mae_mean,
       {r('stddev_pop(global_mae)')} AS global_mae_std, count(*) AS total_folds FROM fm
""")
def q_cv_summary(spark, sf):
    """Mean and population std of the fold MAEs."""
    return rounded(metrics.cv_summary(_fold_metrics_spark(spark, sf)))


@query("oof_aggregate", O.with_ctes(O.base_cte(), "tr AS (SELECT * FROM base WHERE is_train)",
                                    *_strat_label_ctes("tr"),
                                    "rep AS (SELECT * FROM (VALUES (1), (2), (3)) v(repeat))",
                                    "pl AS (SELECT s.SaleID, rep.repeat FROM strat s, rep)",
                                    """pp AS (SELECT pl.SaleID, tr.price * (0.8 + 0.4 * ((pl.SaleID + pl.repeat) % 7) / 6.0) AS pred,
       CASE WHEN (pl.SaleID + pl.repeat) % 3 = 0 THEN 1.0 ELSE 0.0 END AS routed_flag
  FROM pl JOIN tr ON tr.SaleID = pl.SaleID)""") + f"""
SELECT SaleID, {r('avg(pred)')} AS oof_pred, {r('avg(routed_flag)')} AS segmented_replaced_flag,
       count(*) AS cv_prediction_count
FROM pp GROUP BY SaleID
""")
def q_oof_aggregate(spark, sf):
    """Per-row mean over the repeats that validated it (stratified 5 x 3
    plan), with the count; the per-repeat values are a deterministic
    function of price and (id, repeat)."""
    train = base(spark, sf).where(F.col("is_train"))
    plan = folds.stratified_assign(train, 5, 3, 42, 5)
    rows = plan.join(train.select(C.ID_COL, C.TARGET_COL), C.ID_COL).withColumns({
        "oof_pred": F.col(C.TARGET_COL) * (F.lit(0.8) + F.lit(0.4) * ((F.col(C.ID_COL) + F.col("repeat")) % 7) / 6.0),
        "segmented_replaced_flag": F.when((F.col(C.ID_COL) + F.col("repeat")) % 3 == 0, 1.0).otherwise(0.0)})
    return rounded(metrics.oof_aggregate(rows, C.ID_COL, ["oof_pred", "segmented_replaced_flag"]))


@query("regression_metrics", O.with_ctes(*_pred_ctes()) + " " + " UNION ALL ".join(f"""
SELECT '{p}' AS model, {r(f'avg(abs(price - {p}))')} AS mae, {r(f'sqrt(avg((price - {p}) * (price - {p})))')} AS rmse,
       {r(f'1 - sum((price - {p}) * (price - {p})) / nullif(var_pop(price) * count(price), 0)')} AS r2, count(*) AS rows
FROM preds""" for p in PRED_COLS))
def q_regression_metrics(spark, sf):
    """MAE / RMSE / R2 of each fixture predictor (one aggregate each)."""
    p = saved(predictions(spark, sf), "predictions")
    out = None
    for c in PRED_COLS:
        m = metrics.regression_metrics(p, C.TARGET_COL, c).select(F.lit(c).alias("model"), "*")
        out = m if out is None else out.unionByName(m)
    return rounded(out)


@query("error_report", O.with_ctes(*_pred_ctes(), "ae AS (SELECT SaleID, abs(price - p_brand) AS e FROM preds)") + f"""
SELECT * FROM (VALUES
  ('aggregated_oof_mae', (SELECT {r('avg(e)')} FROM ae)),
  ('abs_error_median', (SELECT {r('quantile_cont(e, 0.5)')} FROM ae)),
  ('abs_error_p75', (SELECT {r('quantile_cont(e, 0.75)')} FROM ae)),
  ('abs_error_p90', (SELECT {r('quantile_cont(e, 0.9)')} FROM ae)),
  ('abs_error_p95', (SELECT {r('quantile_cont(e, 0.95)')} FROM ae)),
  ('abs_error_p99', (SELECT {r('quantile_cont(e, 0.99)')} FROM ae)),
  ('worst_10pct_abs_error_share', (SELECT {r('sum(e) FILTER (WHERE rk <= greatest(1, CAST(floor(n * 0.1) AS BIGINT))) / sum(e)')}
      FROM (SELECT e, row_number() OVER (ORDER BY e DESC, SaleID DESC) AS rk, count(*) OVER () AS n FROM ae) z))
) v(metric, value)
""")
def q_error_report(spark, sf):
    """Abs-error quantiles and the worst-10 % share, from one distributed ranking."""
    p = predictions(spark, sf).withColumn("abs_error", F.abs(F.col(C.TARGET_COL) - F.col("p_brand")))
    return rounded(metrics.error_report(p, "abs_error", C.ID_COL))


@query("profile_report", O.with_ctes(O.base_cte(), "tr AS (SELECT * FROM base WHERE is_train)") + f"""
SELECT * FROM (VALUES
  ('train_rows', (SELECT CAST(count(*) AS DOUBLE) FROM tr)),
  ('target_min', (SELECT {r('min(price)')} FROM tr)),
  ('target_median', (SELECT {r('quantile_cont(price, 0.5)')} FROM tr)),
  ('target_mean', (SELECT {r('avg(price)')} FROM tr)),
  ('target_max', (SELECT {r('max(price)')} FROM tr))
) v(metric, value)
""")
def q_profile_report(spark, sf):
    """Train size and target summary as a long-form table."""
    train = base(spark, sf).where(F.col("is_train"))
    return rounded(metrics.profile_report(train, C.TARGET_COL, C.ID_COL))


# ===================================================================== B
from ..operators import blend  # noqa: E402
from ..session import saved, scratch_path  # noqa: E402
from ..sources import io as sio  # noqa: E402
from . import jobs  # noqa: E402

BLEND_STEP = 0.025
BLEND_UNITS = 40
BLEND_MODELS = len(PRED_COLS)


def oof_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """B1: the four fixture OOF tables (id, price, oof_pred) inner-joined on
    (id, price), plus the prediction array and the meta-CV fold."""
    p = saved(predictions(spark, sf), "predictions")
    tables = [(c, p.select(C.ID_COL, C.TARGET_COL, F.col(c).alias("oof_pred"))) for c in PRED_COLS]
    m = blend.load_oof_matrix(tables)
    m = saved(blend.with_pred_array(m, PRED_COLS), "oof-joined")
    return folds.kfold_assign(m, 5, 7, fold_col="meta_fold")


_GRID_SQL = f"""grid AS (
  SELECT row_number() OVER (ORDER BY a, b, c) - 1 AS cand_id, a / {BLEND_UNITS}.0 AS w1, b / {BLEND_UNITS}.0 AS w2, c / {BLEND_UNITS}.0 AS w3,
         ({BLEND_UNITS} - a - b - c) / {BLEND_UNITS}.0 AS w4
  FROM range(0, {BLEND_UNITS + 1}) ta(a), range(0, {BLEND_UNITS + 1}) tb(b), range(0, {BLEND_UNITS + 1}) tc(c) WHERE a + b + c <= {BLEND_UNITS})"""

_MATRIX_SQL = "mx AS (SELECT *, CAST((row_number() OVER (ORDER BY md5(CAST(SaleID AS VARCHAR) || ':7'), SaleID) - 1) % 5 + 1 AS INTEGER) AS meta_fold FROM preds)"

_BLEND_EXPR = "greatest(p_brand * g.w1 + p_model * g.w2 + p_median * g.w3 + p_noisy * g.w4, 0)"


def _w_cols(prefix: str = "g.") -> str:
    return ", ".join(f"{r(prefix + f'w{i + 1}')} AS w_{c}" for i, c in enumerate(PRED_COLS))


def _w_split(df: DataFrame, col: str = "w") -> DataFrame:
    return df.select(*[c for c in df.columns if c != col],
                     *[F.col(col)[i].alias(f"w_{c}") for i, c in enumerate(PRED_COLS)])


@query("oof_matrix", O.with_ctes(*_pred_ctes()) + f"""
SELECT SaleID, {r('price')} AS price, {', '.join(f"{r(c)} AS {c}" for c in PRED_COLS)} FROM preds
""")
def q_oof_matrix(spark, sf):
    """B1: inner join of the per-model OOF tables on (SaleID, price)."""
    return rounded(oof_matrix(spark, sf).select(C.ID_COL, C.TARGET_COL, *PRED_COLS))


@query("weight_grid", O.with_ctes(*_pred_ctes(), _GRID_SQL) + f"""
SELECT g.cand_id, {_w_cols()}, round(avg(abs(price - {_BLEND_EXPR})), 6) + 0.0 AS mae
FROM preds, grid g GROUP BY g.cand_id, g.w1, g.w2, g.w3, g.w4
""")
def q_weight_grid(spark, sf):
    """B3 + B4: the 4-model simplex grid at step 0.025 (12,341 vectors, built in
    Spark with lexicographic ids), each scored on every OOF row."""
    m = oof_matrix(spark, sf)
    grid = blend.weight_grid(spark, BLEND_MODELS, BLEND_STEP).select("cand_id", "w")
    scores = blend.score_candidates(m, grid)
    per = scores.groupBy("cand_id").agg(F.round(F.sum("err") / F.sum("n"), 6).alias("mae"))
    out = _w_split(grid.join(per, "cand_id")).withColumn("mae", F.col("mae") + F.lit(0.0))
    return rounded(out.select("cand_id", *[f"w_{c}" for c in PRED_COLS], "mae"))


@query("blend_grid", O.with_ctes(*_pred_ctes(), _GRID_SQL) + f"""
SELECT rank, cand_id, {', '.join(f"w_{c}" for c in PRED_COLS)}, mae FROM (
  SELECT row_number() OVER (ORDER BY round(avg(abs(price - {_BLEND_EXPR})), 6), g.cand_id) AS rank, g.cand_id,
         {_w_cols()}, round(avg(abs(price - {_BLEND_EXPR})), 6) + 0.0 AS mae
  FROM preds, grid g GROUP BY g.cand_id, g.w1, g.w2, g.w3, g.w4) t
WHERE rank <= 200
""")
def q_blend_grid(spark, sf):
    """B4 + B5: every grid vector scored on every OOF row (partial sums per
    task, no row x candidate materialisation); top 200 by MAE, ties in grid order."""
    m = oof_matrix(spark, sf)
    grid = blend.weight_grid(spark, BLEND_MODELS, BLEND_STEP)
    top = blend.best_of_scores(blend.score_candidates(m, grid), grid, 200, digits=6)
    out = _w_split(top.withColumn("mae", F.col("mae") + F.lit(0.0)))
    return rounded(out.select("rank", "cand_id", *[f"w_{c}" for c in PRED_COLS], "mae"))


_META_SQL = f"""
sc AS (SELECT m.meta_fold AS f, g.cand_id, g.w1, g.w2, g.w3, g.w4, sum(abs(price - {_BLEND_EXPR})) AS err, count(*) AS n
       FROM mx m, grid g GROUP BY 1, 2, 3, 4, 5, 6),
tt AS (SELECT cand_id, sum(err) AS te, sum(n) AS tn FROM sc GROUP BY cand_id),
pf AS (SELECT sc.*, (tt.te - sc.err) / (tt.tn - sc.n) AS train_mae, sc.err / sc.n AS valid_mae,
              row_number() OVER (PARTITION BY sc.f ORDER BY (tt.te - sc.err) / (tt.tn - sc.n), sc.cand_id) AS rk
       FROM sc JOIN tt USING (cand_id)),
ch AS (SELECT * FROM pf WHERE rk = 1)"""


@query("meta_cv", O.with_ctes(*_pred_ctes(), _GRID_SQL, _MATRIX_SQL) + "," + _META_SQL + f"""
SELECT CAST(f AS BIGINT) AS meta_fold, cand_id, {r('train_mae', 6)} AS train_mae, {r('valid_mae', 6)} AS valid_mae,
       {_w_cols('')} FROM ch
""")
def q_meta_cv(spark, sf):
    """Per meta fold, the grid vector that is best on the other folds and
    its error on this fold, from one scoring pass (train error = total - fold)."""
    m = oof_matrix(spark, sf)
    choices, _ = blend.run_meta_cv(m, blend.weight_grid(spark, BLEND_MODELS, BLEND_STEP), "meta_fold")
    out = _w_split(choices).withColumns({"train_mae": F.round("train_mae", 6), "valid_mae": F.round("valid_mae", 6)})
    return rounded(out.select("meta_fold", "cand_id", "train_mae", "valid_mae", *[f"w_{c}" for c in PRED_COLS]))


@query("blend_report", O.with_ctes(*_pred_ctes(), _GRID_SQL, _MATRIX_SQL) + "," + _META_SQL + f""",
best AS (SELECT cand_id, avg(abs(price - {_BLEND_EXPR})) AS mae FROM preds, grid g GROUP BY cand_id ORDER BY mae, cand_id LIMIT 1),
moof AS (SELECT m.price, greatest(m.p_brand * ch.w1 + m.p_model * ch.w2 + m.p_median * ch.w3 + m.p_noisy * ch.w4, 0) AS pred
         FROM mx m JOIN ch ON ch.f = m.meta_fold)
SELECT * FROM (
  SELECT 'n_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM preds
  UNION ALL SELECT 'grid_size', CAST(count(*) AS DOUBLE) FROM grid
  {''.join(f"UNION ALL SELECT 'base_oof_mae_{c}', {r(f'avg(abs(price - greatest({c}, 0)))', 6)} FROM preds " for c in PRED_COLS)}
  UNION ALL SELECT 'best_full_mae', {r('mae', 6)} FROM best
  UNION ALL SELECT 'meta_cv_mae', {r('avg(abs(price - pred))', 6)} FROM moof
  UNION ALL SELECT 'meta_cv_valid_mean', {r('avg(valid_mae)', 6)} FROM ch
  UNION ALL SELECT 'meta_cv_valid_std', {r('stddev_samp(valid_mae)', 6)} FROM ch) t
""")
def q_blend_report(spark, sf):
    """Base MAE per model, best grid MAE, meta-CV MAE and the sample std
    of the meta fold MAEs, as a long-form table."""
    m = saved(oof_matrix(spark, sf), "oof-matrix")
    return rounded(jobs.blend_summary(m, PRED_COLS, "meta_fold", BLEND_STEP)[0].withColumn("value", F.round("value", 6)))


@query("blend_continuous", O.with_ctes(*_pred_ctes(), _GRID_SQL) + f"""
SELECT count(*) AS n_rows, (SELECT {r('min(m)', 6)} FROM (SELECT avg(abs(price - {_BLEND_EXPR})) AS m FROM preds, grid g GROUP BY g.cand_id) t) AS grid_mae,
  TRUE AS no_worse, TRUE AS on_simplex FROM preds
""")
def q_blend_continuous(spark, sf):
    """B8 without a grid: reweighted least squares on the simplex. The weights have no SQL
    form; compared are the grid's best error and that they are no worse (to a part in a
    million) and lie on the simplex."""
    m = saved(oof_matrix(spark, sf), "matrix")
    w, mae, _ = blend.continuous_weights(m, BLEND_MODELS)
    grid = blend.weight_grid(spark, BLEND_MODELS, BLEND_STEP).select("cand_id", "w")
    best = blend.score_candidates(m, grid).groupBy("cand_id").agg((F.sum("err") / F.sum("n")).alias("mae")).agg(F.min("mae").alias("grid_mae"))
    n = m.agg(F.count(F.lit(1)).alias("n_rows"))
    out = best.join(F.broadcast(n)).select("n_rows", F.round("grid_mae", 6).alias("grid_mae"), (F.lit(mae) <= F.col("grid_mae") * (1 + 1e-6)).alias("no_worse"),
                                           F.lit(abs(sum(w) - 1) < 1e-9 and min(w) >= 0).alias("on_simplex"))
    return rounded(out)


@query("submission_matrix", O.with_ctes(*_pred_ctes()) + f"""
SELECT SaleID, {', '.join(f"{r(c)} AS {c}" for c in PRED_COLS)} FROM preds
""")
def q_submission_matrix(spark, sf):
    """B2: inner join of the models' prediction tables on SaleID."""
    p = saved(predictions(spark, sf), "predictions")
    tables = {c: p.select(C.ID_COL, F.col(c).alias("price")) for c in reversed(PRED_COLS)}
    return rounded(blend.load_submission_matrix(PRED_COLS, tables))


@query("blend_submission", O.with_ctes(*_pred_ctes(), _GRID_SQL) + f""",
best AS (SELECT cand_id, round(avg(abs(price - {_BLEND_EXPR})), 6) AS mae, any_value(g.w1) AS w1, any_value(g.w2) AS w2, any_value(g.w3) AS w3, any_value(g.w4) AS w4
         FROM preds, grid g GROUP BY cand_id ORDER BY mae, cand_id LIMIT 1)
SELECT SaleID, {r(_BLEND_EXPR)} AS price FROM preds, best g
""")
def q_blend_submission(spark, sf):
    """B10 + S10: the blend job writes top candidates, choices, blended OOF and
    submissions; the submission is read back from its folder."""
    p = saved(predictions(spark, sf), "predictions")
    out = scratch_path(spark, "blend-job")
    oof = [(c, p.select(C.ID_COL, C.TARGET_COL, F.col(c).alias("oof_pred"))) for c in PRED_COLS]
    jobs.blend_job(oof, {c: p.select(C.ID_COL, F.col(c).alias("price")) for c in PRED_COLS}, out, BLEND_STEP)
    return rounded(sio.read_csv(spark, f"{out}/submission", "SaleID long, price double"))


@query("blend_local_search")
def q_blend_local_search(spark, sf):
    """B8 + B9 (optimize mode): searches from equal and single-model weights on ever
    finer grids down to step 0.025, for all rows and without each meta fold (no SQL
    oracle: iterative; the tests hold it against the full grid)."""
    m = saved(oof_matrix(spark, sf), "oof-matrix")
    return _w_split(blend.optimize(m, BLEND_MODELS, BLEND_STEP, "meta_fold"))


_NEAR_UNITS = 20
_CENTRE_SQL = f"""mae AS (SELECT {', '.join(f"avg(abs(price - greatest({c}, 0))) AS m{i + 1}" for i, c in enumerate(PRED_COLS))} FROM preds),
raw AS (SELECT i, (1 / m) / (SELECT sum(1 / m) FROM (SELECT unnest([m1, m2, m3, m4]) AS m FROM mae)) * {_NEAR_UNITS} AS x
        FROM (SELECT unnest([1, 2, 3, 4]) AS i, unnest([m1, m2, m3, m4]) AS m FROM mae)),
flo AS (SELECT i, CAST(floor(x + 1e-9) AS INTEGER) AS u, round(x - floor(x + 1e-9), 9) AS rest FROM raw),
rou AS (SELECT i, u + CASE WHEN row_number() OVER (ORDER BY rest DESC, i DESC) <= {_NEAR_UNITS} - (SELECT sum(u) FROM flo) THEN 1 ELSE 0 END AS u FROM flo),
c AS (SELECT max(u) FILTER (WHERE i = 1) AS c1, max(u) FILTER (WHERE i = 2) AS c2, max(u) FILTER (WHERE i = 3) AS c3, max(u) FILTER (WHERE i = 4) AS c4 FROM rou),
cells AS (SELECT a, b, e, {_NEAR_UNITS} - a - b - e AS f FROM range(0, {_NEAR_UNITS + 1}) t1(a), range(0, {_NEAR_UNITS + 1}) t2(b), range(0, {_NEAR_UNITS + 1}) t3(e)
          WHERE a + b + e <= {_NEAR_UNITS})"""


@query("neighbor_grids", O.with_ctes(*_pred_ctes()) + "," + _CENTRE_SQL + f"""
SELECT kind, {', '.join(f"{r(f'{v} / {_NEAR_UNITS}.0')} AS w_{c}" for v, c in zip('abef', PRED_COLS))} FROM (
  SELECT 'rounded' AS kind, a, b, e, f FROM cells, c WHERE abs(a - c1) <= 5 AND abs(b - c2) <= 5 AND abs(e - c3) <= 5
  UNION ALL SELECT 'pairwise', a, b, e, f FROM cells, c
  WHERE abs(a - c1) + abs(b - c2) + abs(e - c3) + abs(f - c4) <= 4
    AND CAST(a <> c1 AS INT) + CAST(b <> c2 AS INT) + CAST(e <> c3 AS INT) + CAST(f <> c4 AS INT) <= 2) t
""")
def q_neighbor_grids(spark, sf):
    """B6 + B7: centre = inverse-MAE weights of the models, rounded to the 0.05 grid
    by largest remainder; its box (radius by the rule: 5) and transfer neighbourhoods."""
    errors = oof_matrix(spark, sf).agg(F.array(*[
        1.0 / F.avg(F.abs(F.col(C.TARGET_COL) - F.greatest(F.col(c), F.lit(0.0)))) for c in PRED_COLS]).alias("inverse"))
    total = F.aggregate("inverse", F.lit(0.0), lambda a, x: a + x)
    centre = saved(errors.select(blend.rounded_units(F.transform("inverse", lambda x: x / total), _NEAR_UNITS).alias("units")), "blend-centre")
    box = blend.neighbours(centre, BLEND_MODELS, _NEAR_UNITS).select(F.lit("rounded").alias("kind"), "units")
    moves = blend.transfer_neighbours(centre, BLEND_MODELS, 2).select(F.lit("pairwise").alias("kind"), "units")
    both = box.unionByName(moves).select("kind", blend.weights_of(F.col("units"), _NEAR_UNITS).alias("w"))
    return rounded(_w_split(both))


# ===================================================================== M5-M14
from ..config import Segment  # noqa: E402
from ..operators import learners, ml  # noqa: E402

NUM_FEATURES = ["power", "kilometer", "v_0", "v_1", "v_2", "v_3", "v_4", "car_age_years", "power_outlier_flag",
                "power_is_zero", "reg_year", "create_year"]
CAT_FEATURES = list(C.CATEGORICAL_COLUMNS)
# the whole preset: 400 trees of depth 6 at rate 0.08
PRESET = ml.learner("lightgbm")
# the published grid: rates, trees, leaves
TUNED = ([0.06, 0.08, 0.10], [300, 400, 500], [31, 63, 95])


@query("median_impute", O.with_ctes(O.base_cte(), "tr AS (SELECT * FROM base WHERE is_train)",
                                    "med AS (SELECT " + ", ".join(
                                        f"quantile_cont({c}, 0.5) AS m_{c}" for c in NUM_FEATURES) + " FROM tr)") +
       "\nSELECT b.SaleID, " + ", ".join(f"{r(f'coalesce(CAST(b.{c} AS DOUBLE), med.m_{c})')} AS {c}"
                                         for c in NUM_FEATURES) + "\nFROM base b, med WHERE NOT b.is_train")
def q_median_impute(spark, sf):
    """M5 numeric side: exact train medians of all numeric features from one
    stacked ranking, imputed into the test rows."""
    df = base(spark, sf)
    meds = ml.exact_medians(df.where(F.col("is_train")), NUM_FEATURES)
    test = df.where(~F.col("is_train"))
    return rounded(test.select(C.ID_COL, *[F.coalesce(F.col(c).cast("double"), F.lit(meds[c])).alias(c)
                                           for c in NUM_FEATURES]))


@query("ordinal_codes", O.with_ctes(
    O.base_cte(),
    "cb AS (SELECT SaleID, is_train, " + ", ".join(f"{O.cat_text(c)} AS {c}" for c in CAT_FEATURES) + " FROM base)",
    *[f"d_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS DOUBLE) AS code FROM "
      f"(SELECT DISTINCT {c} AS v FROM cb WHERE is_train) x)" for c in CAT_FEATURES]) +
       "\nSELECT a.SaleID, " + ", ".join(f"coalesce(d_{c}.code, -1.0) AS {c}__code" for c in CAT_FEATURES) +
       "\nFROM cb a " + " ".join(f"LEFT JOIN d_{c} ON d_{c}.v = a.{c}" for c in CAT_FEATURES) +
       "\nWHERE NOT a.is_train")
def q_ordinal_codes(spark, sf):
    """M5 categorical side: sorted-order codes fitted on train rows (one
    ranking over all columns' distinct values), unseen test values -> -1."""
    df = enc_frame(spark, sf)
    codes = ml.fit_ordinal_codes(df.where(F.col("is_train")), CAT_FEATURES)
    pre = ml.Preprocessor({}, codes, (), tuple(CAT_FEATURES))
    out = pre.transform(df.where(~F.col("is_train")))
    return rounded(out.select(C.ID_COL, *[f"{c}__code" for c in CAT_FEATURES]))


def _model_rows(spark, sf):
    """The listings with the columns that models and segments read, written once: fits pass
    over them many times."""
    cols = [C.ID_COL, C.TARGET_COL, "is_train", *dict.fromkeys([*NUM_FEATURES, *CAT_FEATURES])]
    return saved(enc_frame(spark, sf).select(*cols), "model-rows")


@query("gbt_full_predict")
def q_gbt_full_predict(spark, sf):
    """M6 + M7 + M10: GBT with encodings and legacy weights fitted on all train rows
    (log1p target), test rows predicted (rows-only check)."""
    df = _model_rows(spark, sf)
    pred, _ = ml.fit_full_and_predict(df.where(F.col("is_train")), df.where(~F.col("is_train")), NUM_FEATURES, CAT_FEATURES,
                                      PRESET, enc=_FULL_ENCODINGS, rules=weights.WEIGHTINGS["legacy"])
    return pred.select(C.ID_COL, F.round("prediction", 6).alias("price"))


_FULL_ENCODINGS = Encodings(("brand_target_mean", "model_backoff_target_mean", "model_power_age_backoff_target_mean"))


@query("gbt_segmented")
def q_gbt_segmented(spark, sf):
    """Global model plus a segment model (own encodings and weights) that
    overwrites routed test predictions (rows-only check)."""
    df = _model_rows(spark, sf)
    pred, _ = ml.fit_full_and_predict(df.where(F.col("is_train")), df.where(~F.col("is_train")), NUM_FEATURES, CAT_FEATURES,
                                      PRESET, Segment(enabled=True), enc=_FULL_ENCODINGS)
    return pred.select(C.ID_COL, "routed", F.round("prediction", 6).alias("price"))


@query("gbt_cv_oof")
def q_gbt_cv_oof(spark, sf):
    """M11 + M12: 5 stratified folds x 3 repeats with encodings and segment routing; OOF
    table per row (rows-only check)."""
    train = _model_rows(spark, sf).where(F.col("is_train"))
    plan = folds.stratified_assign(train, n_splits=5, repeats=3, seed=42, price_bins=5)
    preds, _ = ml.cross_validate(train, plan, NUM_FEATURES, CAT_FEATURES, PRESET, Segment(enabled=True), enc=_FULL_ENCODINGS)
    return ml.oof_table(preds)


@query("gbt_tune")
def q_gbt_tune(spark, sf):
    """3 x 3 x 3 grid over 3 folds, ranked by mean fold MAE (rows-only check)."""
    train = _model_rows(spark, sf).where(F.col("is_train"))
    plan = folds.cv_plan(train, n_splits=3, strategy="kfold", seed=42)
    return ml.tune(train, plan, NUM_FEATURES, CAT_FEATURES, *TUNED, PRESET)


# The plainest learner gives the whole of M10, M11 and M13 an exact counterpart in SQL:
# fits are brand means of ln(1 + price), refitted on segment rows for routed ones.
_IN_SEGMENT = f"{O.age_bin('car_age_years')} IN ('5_8y', '8y_plus')"


def _means_sql(fits: str, applies: str, ids: str) -> list[str]:
    """CTEs from `fits` (fold key f, price, brand, age) and `applies`: thresholds,
    global and segment means, routed rows and predictions."""
    return [
        f"th AS (SELECT f, quantile_cont(price, 0.8) AS edge FROM {fits} GROUP BY f)",
        f"ft AS (SELECT x.*, th.edge, coalesce(price >= edge AND {_IN_SEGMENT}, false) AS seg FROM {fits} x JOIN th USING (f))",
        "gm AS (SELECT f, avg(ln(1 + greatest(price, 0))) AS m, avg(ln(1 + greatest(price, 0))) FILTER (WHERE seg) AS sm, count(*) FILTER (WHERE seg) AS sn FROM ft GROUP BY f)",
        "bm AS (SELECT f, brand, avg(ln(1 + greatest(price, 0))) AS m, avg(ln(1 + greatest(price, 0))) FILTER (WHERE seg) AS sm FROM ft GROUP BY f, brand)",
        f"ap AS (SELECT a.{ids}, a.price, a.f, a.car_age_years, th.edge, gm.sn, greatest(exp(coalesce(bm.m, gm.m)) - 1, 0) AS g, "
        f"greatest(exp(coalesce(bm.sm, gm.sm)) - 1, 0) AS s FROM {applies} a JOIN th USING (f) JOIN gm USING (f) "
        "LEFT JOIN bm ON bm.f = a.f AND bm.brand IS NOT DISTINCT FROM a.brand)",
        f"pr AS (SELECT *, sn >= 20 AND coalesce(g >= edge AND {_IN_SEGMENT}, false) AS routed, coalesce(price >= edge AND {_IN_SEGMENT}, false) AS actual FROM ap)",
        "fi AS (SELECT *, CASE WHEN routed THEN s ELSE g END AS pred FROM pr)"]


def _mean_frames() -> list[str]:
    return [O.base_cte(), _enc_rows_cte("e0", "price"), "er AS (SELECT *, t AS price FROM e0)", "tr AS (SELECT * FROM er WHERE is_train)"]


@query("mean_full_segmented", O.with_ctes(*_mean_frames(), "fa AS (SELECT *, 0 AS f FROM tr)", "ta AS (SELECT *, 0 AS f FROM er WHERE NOT is_train)",
                                          *_means_sql("fa", "ta", "SaleID")) + f"""
SELECT SaleID, routed, {r('g')} AS global_pred, {r('pred')} AS prediction FROM fi""")
def q_mean_full_segmented(spark, sf):
    """M10 with brand means as the learner: test predictions, routed ones replaced."""
    df = _model_rows(spark, sf)
    pred, _ = ml.fit_full_and_predict(df.where(F.col("is_train")), df.where(~F.col("is_train")), [], [], learners.GroupMean("brand"), Segment(enabled=True))
    return rounded(pred.select(C.ID_COL, "routed", "global_pred", "prediction"))


def _cv_means_sql() -> list[str]:
    return [*_mean_frames(), _kfold_cte("tr", "kf"), "fa AS (SELECT kf.*, g.f FROM kf, (SELECT DISTINCT fold AS f FROM kf) g WHERE kf.fold <> g.f)",
            "va AS (SELECT *, fold AS f FROM kf)", *_means_sql("fa", "va", "SaleID")]


def _mean_cv(spark, sf):
    train = _model_rows(spark, sf).where(F.col("is_train"))
    plan = folds.kfold_assign(train.select(C.ID_COL), 5, 42).withColumn("repeat", F.lit(1))
    return ml.cross_validate(train, plan, [], [], learners.GroupMean("brand"), Segment(enabled=True))


@query("mean_cv_oof", O.with_ctes(*_cv_means_sql()) + f"""
SELECT SaleID, {r('pred')} AS oof_pred, {r('g')} AS global_oof_pred, CAST(routed AS DOUBLE) AS segmented_replaced_flag,
       CAST(actual AS DOUBLE) AS actual_segment_flag, CAST(routed AND actual AS DOUBLE) AS routing_hit_flag, {r('abs(price - pred)')} AS abs_error FROM fi""")
def q_mean_cv_oof(spark, sf):
    """M11 + M12 with brand means as the learner: 5-fold out-of-fold table."""
    preds, _ = _mean_cv(spark, sf)
    return rounded(ml.oof_table(preds).select(C.ID_COL, "oof_pred", "global_oof_pred", "segmented_replaced_flag", "actual_segment_flag",
                                              "routing_hit_flag", "abs_error"))


@query("mean_cv_folds", O.with_ctes(*_cv_means_sql()) + f"""
SELECT CAST(f AS BIGINT) AS fold, {r('avg(abs(price - pred))')} AS mae, {r('avg(abs(price - g))')} AS global_mae,
       CAST(sum(CAST(actual AS INT)) AS BIGINT) AS actual_segment_count, CAST(sum(CAST(routed AS INT)) AS BIGINT) AS routed_count,
       {r('sum(CAST(routed AS INT)) * 1.0 / count(*)')} AS segment_coverage_rate,
       {r('sum(CAST(routed AND actual AS INT)) * 1.0 / nullif(sum(CAST(routed AS INT)), 0)')} AS routing_precision,
       {r('sum(CAST(routed AND actual AS INT)) * 1.0 / nullif(sum(CAST(actual AS INT)), 0)')} AS routing_recall,
       {r('avg(abs(price - pred)) FILTER (WHERE actual)')} AS segment_mae, {r('avg(abs(price - g)) FILTER (WHERE actual)')} AS global_segment_mae,
       {r('avg(abs(price - pred)) FILTER (WHERE NOT actual)')} AS non_segment_mae, count(*) AS valid_rows,
       any_value(sn) AS segment_train_count, {r('any_value(edge)')} AS segment_threshold FROM fi GROUP BY f""")
def q_mean_cv_folds(spark, sf):
    """M11 + M13 with brand means as the learner: metrics of each fold."""
    _, per_fold = _mean_cv(spark, sf)
    return rounded(per_fold.drop("setting", "repeat", "weighted_sample_count", "weight_mean", "weight_min", "weight_max", "weight_non_default_count"))


# ===================================================================== S

_RAW_COLUMNS = list(C.COMMON_REQUIRED_COLUMNS) + ["price", *[f"v_{i}" for i in range(5)]]


def _raw_files(spark, sf) -> tuple[str, str]:
    """The listings written as raw files: single spaces, header, columns in another order
    than the reader's, mileage and region codes within their ranges."""
    most = C.VALUE_RANGE_CHECKS["regionCode"][1]
    region = F.when(F.col("regionCode") > most, F.col("regionCode") % (most + 1)).otherwise(F.col("regionCode"))
    rows = saved(listings(spark, sf).withColumns({"kilometer": F.least("kilometer", F.lit(15.0)), "regionCode": region}), "raw-rows")
    train, test = fixture.split_train_test(rows)
    out = scratch_path(spark, "raw")
    sio.save_raw_listing(train.select(*reversed(_RAW_COLUMNS)), f"{out}/train")
    sio.save_raw_listing(test.select(*reversed([c for c in _RAW_COLUMNS if c != "price"])), f"{out}/test")
    return f"{out}/train", f"{out}/test"


_RAW_SQL = f"""SaleID, name, regDate, creatDate, {r('model')} AS model, brand, {r('bodyType')} AS bodyType,
       {r('power')} AS power, {r('least(kilometer, 15)')} AS kilometer, notRepairedDamage"""


@query("csv_roundtrip", O.with_ctes() + f"""
SELECT {_RAW_SQL}, {r('price')} AS price FROM listings WHERE is_train
UNION ALL SELECT {_RAW_SQL}, NULL FROM listings WHERE NOT is_train
""")
def q_csv_roundtrip(spark, sf):
    """S1 + S3 + V4: listings written as raw files and read by their headers with the
    trainer's scan (empty fields -> NULL, ranges checked)."""
    train, test = sio.load_data(spark, *_raw_files(spark, sf))
    cols = ["SaleID", "name", "regDate", "creatDate", "model", "brand", "bodyType", "power", "kilometer", "notRepairedDamage"]
    return rounded(train.select(*cols, "price").unionByName(test.select(*cols), allowMissingColumns=True))


@query("make_data", O.with_ctes() + f"""
SELECT {_RAW_SQL.replace("notRepairedDamage", "nullif(notRepairedDamage, '-') AS notRepairedDamage")
        .replace("regDate, creatDate", "CAST(regDate AS DOUBLE) AS regDate, CAST(creatDate AS DOUBLE) AS creatDate")}, {r('price')} AS price
FROM listings WHERE is_train""")
def q_make_data(spark, sf):
    """S2 + S5 + S11 + V1 + V3 + C5: raw files checked, cleaned, written as Parquet and read back (train)."""
    train, _ = jobs.make_data(spark, *_raw_files(spark, sf), scratch_path(spark, "data"))
    cols = ["SaleID", "name", "model", "brand", "bodyType", "power", "kilometer", "notRepairedDamage", "price"]
    return rounded(train.select(*cols, F.col("regDate").cast("double").alias("regDate"), F.col("creatDate").cast("double").alias("creatDate")))


@query("make_features", "SELECT * FROM (" + _proxy_sql("price", "_price_mean", oof=True) + ") UNION ALL SELECT * FROM ("
       + _proxy_sql("price", "_price_mean", oof=False) + ")")
def q_make_features(spark, sf):
    """P3 + S12: features of the cleaned tables with out-of-fold and full-train price
    means, written as Parquet and read back (the price means of train and test rows)."""
    out = scratch_path(spark, "features")
    jobs.make_data(spark, *_raw_files(spark, sf), f"{out}/data")
    train, test = jobs.make_features(spark, f"{out}/data", f"{out}/features", price_proxies=True)
    cols = [C.ID_COL, "brand_price_mean", "model_price_mean"]
    return rounded(train.select(*cols).unionByName(test.select(*cols)))


@query("submission_projection", _proxy_sql("price", "_price_mean", oof=False).replace(
    f"SELECT a.SaleID, {r(_sm('brand'))} AS brand_price_mean, {r(_sm('model'))} AS model_price_mean",
    f"SELECT a.SaleID, {r(_sm('brand'))} AS price"))
def q_submission_projection(spark, sf):
    """S7 + S8 + C9: test predictions (full-train brand price means) written as a
    submission (SaleID, price) to two places, read back with the submission loader."""
    df = enc_frame(spark, sf)
    train, test = df.where(F.col("is_train")), df.where(~F.col("is_train")).drop(C.TARGET_COL)
    enc = encode.fit_price_proxy_encoder(train, C.TARGET_COL, ("brand",), SMOOTH)
    pred = enc.transform(test).withColumnRenamed("brand_price_mean", "price")
    path = scratch_path(spark, "submission")
    jobs.make_submission(pred, f"{path}/latest", f"{path}/kept")
    return rounded(sio.load_submission(spark, "price", f"{path}/kept"))


@query("leafwise_predict")
def q_leafwise_predict(spark, sf):
    """M6 + M7 with the leaf-wise preset, 400 trees of 63 leaves (rows-only check); tests hold
    the grower against a plain one."""
    df = _model_rows(spark, sf)
    model = ml.fit_model(df.where(F.col("is_train")), NUM_FEATURES, CAT_FEATURES, ml.learner("leafwise"))
    return model.predict(df.where(~F.col("is_train")), "price").select(C.ID_COL, F.round("price", 6).alias("price"))


def _trained(spark, sf) -> tuple[str, DataFrame]:
    """The training job with brand means as the learner, on 5 folds."""
    df = _model_rows(spark, sf)
    train, test = df.where(F.col("is_train")), df.where(~F.col("is_train"))
    plan = folds.kfold_assign(train.select(C.ID_COL), 5, 42).withColumn("repeat", F.lit(1))
    out = scratch_path(spark, "trained")
    return out, jobs.train_job(train, test, plan, [], [], learners.GroupMean("brand"), out, seg=Segment(enabled=True))


_FULL_FIT = ["fa AS (SELECT *, 0 AS f FROM tr)", "ta AS (SELECT *, 0 AS f FROM er WHERE NOT is_train)", *_means_sql("fa", "ta", "SaleID")]


@query("train_outputs", "SELECT * FROM (" + O.with_ctes(*_cv_means_sql()) + f" SELECT 'oof' AS kind, SaleID, {r('price')} AS price, {r('pred')} AS prediction, {r('abs(price - pred)')} AS abs_error FROM fi) UNION ALL SELECT * FROM ("
       + O.with_ctes(*_mean_frames(), *_FULL_FIT) + f" SELECT 'submission', SaleID, {r('pred')}, NULL, NULL FROM fi)")
def q_train_outputs(spark, sf):
    """The training job's validation predictions and submission, read from its files."""
    out, _ = _trained(spark, sf)
    valid = sio.load_oof(spark, "oof_pred", f"{out}/oof_predictions").select(C.ID_COL)
    told = spark.read.option("header", True).csv(f"{out}/valid_predictions").select(
        F.col(C.ID_COL).cast("long").alias(C.ID_COL), *[F.col(c).cast("double").alias(c) for c in (C.TARGET_COL, "prediction", "abs_error")])
    both = told.join(valid, C.ID_COL).select(F.lit("oof").alias("kind"), C.ID_COL, C.TARGET_COL, "prediction", "abs_error")
    sub = sio.load_submission(spark, C.TARGET_COL, f"{out}/submission")
    none = F.lit(None).cast("double")
    return rounded(both.unionByName(sub.select(F.lit("submission").alias("kind"), C.ID_COL, C.TARGET_COL, none.alias("prediction"), none.alias("abs_error"))))


@query("train_metrics", O.with_ctes(*_cv_means_sql(), "fo AS (SELECT f, avg(abs(price - pred)) AS mae, avg(abs(price - g)) AS gmae FROM fi GROUP BY f)") + f"""
SELECT metric, {r('value')} AS value FROM (
  SELECT 'mae_mean' AS metric, avg(mae) AS value FROM fo UNION ALL SELECT 'mae_std', stddev_pop(mae) FROM fo
  UNION ALL SELECT 'global_mae_mean', avg(gmae) FROM fo UNION ALL SELECT 'global_mae_std', stddev_pop(gmae) FROM fo
  UNION ALL SELECT 'total_folds', count(*) FROM fo UNION ALL SELECT 'aggregated_oof_mae', avg(abs(price - pred)) FROM fi
  UNION ALL SELECT 'aggregated_global_oof_mae', avg(abs(price - g)) FROM fi)""")
def q_train_metrics(spark, sf):
    """E4 in the training job's metrics file: fold errors and the overall OOF error."""
    _, found = _trained(spark, sf)
    names = ["mae_mean", "mae_std", "global_mae_mean", "global_mae_std", "total_folds", "aggregated_oof_mae", "aggregated_global_oof_mae"]
    return rounded(found.where(F.col("metric").isin(names)))


@query("predict_bundle", O.with_ctes(*_mean_frames(), *_FULL_FIT) + f" SELECT SaleID, {r('pred')} AS prediction FROM fi")
def q_predict_bundle(spark, sf):
    """Test predictions from the saved bundle, its segment model included."""
    out, _ = _trained(spark, sf)
    test = _model_rows(spark, sf).where(~F.col("is_train"))
    return rounded(jobs.predict_job(test, f"{out}/model", scratch_path(spark, "predicted"), routed=True))


@query("blend_files", ORACLE["blend_report"])
def q_blend_files(spark, sf):
    """S6 + B10: the blend job on OOF files; its summary equals that of the tables."""
    p = saved(predictions(spark, sf), "predictions")
    paths = {c: scratch_path(spark, "oof-file") for c in PRED_COLS}
    for c, path in paths.items():
        sio.save_csv(p.select(C.ID_COL, C.TARGET_COL, F.col(c).alias("oof_pred")), path)
    out = jobs.blend_files_job(spark, paths, None, scratch_path(spark, "blended"), step=BLEND_STEP)
    return rounded(out.withColumn("value", F.round("value", 6)))


# ============================================ residuals: calibration, slices, promotion
from ..operators import residuals  # noqa: E402


def oof_rows(spark: SparkSession, sf: str) -> DataFrame:
    """An OOF table with its fold and the columns that slices and cells use: `oof_pred` is
    the model encoding, `other_pred` the brand encoding."""
    rows = _folded_rows(spark, sf)
    oof = encode.build_oof_price_proxy_features(rows, "fold", 5, C.TARGET_COL, ("brand", "model"), SMOOTH)
    return saved(oof.select(C.ID_COL, C.TARGET_COL, "fold", "car_age_years", "power", "brand", F.col("model_price_mean").alias("oof_pred"),
                            F.col("brand_price_mean").alias("other_pred")), "oof-rows")


def _oof_ctes() -> list[str]:
    ex = {"brand": _sm("brand"), "model": _sm("model")}
    return [O.base_cte(), _enc_rows_cte("er", "price"), "tr AS (SELECT * FROM er WHERE is_train)",
            _kfold_cte("tr", "kf"), "ap AS (SELECT kf.*, kf.fold AS afold FROM kf)", *_enc_stat_ctes("kf", "ap", ["brand", "model"]),
            f"""oo AS MATERIALIZED (SELECT a.SaleID, a.t AS price, a.fold, a.car_age_years, a.power, a.brand, {ex['model']} AS oof_pred,
  {ex['brand']} AS other_pred FROM ap a {_enc_joins(['brand', 'model'])})"""]


def _calibration_ctes(kind: str, shrink: float = 50.0) -> list[str]:
    """Cells, medians without each fold by brute force, shrunk level by level, and `cal`."""
    value = "price - oof_pred" if kind == "additive" else "CASE WHEN oof_pred > 0 THEN price / oof_pred END"
    new = "oof_pred + correction" if kind == "additive" else "oof_pred * correction"
    ctes = [*_oof_ctes(), "ed AS (SELECT DISTINCT unnest(quantile_cont(oof_pred, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS x FROM oo)",
            f"""cl AS MATERIALIZED (SELECT *, b AS cell1, b || '|' || {O.age_bin('car_age_years')} AS cell2,
  b || '|' || {O.age_bin('car_age_years')} || '|' || {O.power_bin('power')} AS cell3, {value} AS v FROM (
  SELECT *, 'b' || (SELECT count(*) FROM ed WHERE oo.oof_pred > ed.x) AS b FROM oo) t)""",
            "gs AS (SELECT DISTINCT fold AS g FROM cl UNION ALL SELECT 0)",
            "m0 AS (SELECT g, quantile_cont(v, 0.5) AS c FROM gs JOIN cl ON cl.fold <> gs.g WHERE v IS NOT NULL GROUP BY g)"]
    for i in (1, 2, 3):
        up = "JOIN m0 u ON u.g = x.g" if i == 1 else f"JOIN l{i - 1} u ON u.g = x.g AND u.k = array_to_string(string_split(x.k, '|')[1:{i - 1}], '|')"
        ctes.append(f"""l{i} AS (SELECT x.g, x.k, (x.n * x.m + {shrink} * u.c) / (x.n + {shrink}) AS c FROM (
  SELECT g, cell{i} AS k, quantile_cont(v, 0.5) AS m, count(*) AS n FROM gs JOIN cl ON cl.fold <> gs.g WHERE v IS NOT NULL GROUP BY 1, 2) x {up})""")
    ctes.append(f"""cal AS MATERIALIZED (SELECT *, greatest({new}, 0) AS calibrated FROM (SELECT cl.*, coalesce(l3.c, l2.c, l1.c, m0.c) AS correction FROM cl
  JOIN m0 ON m0.g = cl.fold LEFT JOIN l1 ON l1.g = cl.fold AND l1.k = cell1 LEFT JOIN l2 ON l2.g = cl.fold AND l2.k = cell2
  LEFT JOIN l3 ON l3.g = cl.fold AND l3.k = cell3) t)""")
    return ctes


def _calibration_sql(kind: str) -> str:
    return O.with_ctes(*_calibration_ctes(kind)) + f"""
SELECT SaleID, fold, {r('oof_pred')} AS oof_pred, {r('correction')} AS correction, {r('calibrated')} AS calibrated FROM cal"""


def _calibrated(spark, sf, kind: str) -> DataFrame:
    out = residuals.calibrate(oof_rows(spark, sf), "oof_pred", kind)
    return rounded(out.select(C.ID_COL, "fold", "oof_pred", "correction", "calibrated"))


@query("calibrate_additive", _calibration_sql("additive"))
def q_calibrate_additive(spark, sf):
    """Every OOF prediction plus the median residual of its cell (prediction bucket, age,
    power) on the other folds, shrunk toward the cells above."""
    return _calibrated(spark, sf, "additive")


@query("calibrate_ratio", _calibration_sql("ratio"))
def q_calibrate_ratio(spark, sf):
    """The same with the median quotient of price and prediction."""
    return _calibrated(spark, sf, "ratio")


def _slices_sql() -> str:
    keys = ["age_bin", "power_bin", "price_band", "brand"]
    sets = ", ".join("(" + ", ".join(x) + ")" for x in residuals.SLICES)
    told = {k: f"(gid & {1 << (3 - i)}) = 0" for i, k in enumerate(keys)}
    counts = ", ".join(f"count(CASE WHEN abs(e) <= {x} THEN 1 END) AS c{i}" for i, x in enumerate(residuals.ERROR_EDGES))
    first = lambda q: "CASE " + " ".join(f"WHEN c{i} >= {q} * n THEN {x}" for i, x in enumerate(residuals.ERROR_EDGES)) + " END"
    band = "'b' || (" + " + ".join(f"(price > {x})::INT" for x in (1000, 5000, 20000, 100000)) + ")"
    return O.with_ctes(*_oof_ctes(), f"""el AS (SELECT {O.age_bin('car_age_years')} AS age_bin, {O.power_bin('power')} AS power_bin,
  CASE WHEN price IS NULL THEN '__PRED_MISSING__' ELSE {band} END AS price_band, brand, oof_pred - price AS e FROM oo WHERE price IS NOT NULL)""",
        f"""gg AS (SELECT grouping(age_bin, power_bin, price_band, brand) AS gid, age_bin, power_bin, price_band, brand, count(*) AS n, sum(e) AS se, sum(abs(e)) AS sa,
  sum(e * e) AS sq, {counts} FROM el GROUP BY GROUPING SETS ({sets}))""") + f"""
SELECT concat_ws('|', {', '.join(f"CASE WHEN {t} THEN '{k}' END" for k, t in told.items())}) AS slice, {', '.join(f"CASE WHEN {t} THEN {k} ELSE '*' END AS {k}" for k, t in told.items())},
  n, {r('se / n')} AS bias, {r('sa / n')} AS mae, {r('sqrt(sq / n)')} AS rmse, {r("sa / (SELECT sa FROM gg WHERE gid = 15)")} AS share,
  {', '.join(f'c{i} AS within_{x:g}' for i, x in enumerate(int(v) for v in residuals.ERROR_EDGES))}, {first(0.5)} + 0.0 AS p50_below, {first(0.9)} + 0.0 AS p90_below FROM gg"""


@query("error_slices", _slices_sql().replace(":g}", "}"))
def q_error_slices(spark, sf):
    """Errors of the OOF table by slices of age, power, price and brand."""
    out = residuals.error_slices(oof_rows(spark, sf), "oof_pred")
    edges = [F.col("within")[i].alias(f"within_{int(x):g}") for i, x in enumerate(residuals.ERROR_EDGES)]
    return rounded(out.select("slice", "age_bin", "power_bin", "price_band", "brand", "n", "bias", "mae", "rmse", "share",
                              *edges, "p50_below", "p90_below"))


@query("selective_uplift", O.with_ctes(
    *_calibration_ctes("additive"),
    "ga AS (SELECT fold, cell2 AS cell, sum(abs(price - oof_pred) - abs(price - calibrated)) AS gain, count(*) AS n FROM cal WHERE price IS NOT NULL GROUP BY 1, 2)",
    "ot AS (SELECT f.g AS fold, a.cell, sum(a.gain) AS gain, sum(a.n) AS n FROM gs f JOIN ga a ON a.fold <> f.g WHERE f.g > 0 GROUP BY 1, 2)",
    "ru AS (SELECT *, sum(gain) OVER w AS running, row_number() OVER w AS place FROM ot WINDOW w AS (PARTITION BY fold ORDER BY gain / n DESC, cell ROWS UNBOUNDED PRECEDING))",
    "be AS (SELECT fold, arg_max(place, running) AS last FROM (SELECT fold, place, running FROM ru ORDER BY fold, place DESC) t WHERE running > 0 GROUP BY fold)",
    "ch AS (SELECT ru.fold, ru.cell FROM ru JOIN be USING (fold) WHERE ru.place <= be.last)") + f"""
SELECT SaleID, cal.fold, ch.cell IS NOT NULL AS chosen, {r('CASE WHEN ch.cell IS NULL THEN oof_pred ELSE calibrated END')} AS uplifted
FROM cal LEFT JOIN ch ON ch.fold = cal.fold AND ch.cell = cal.cell2""")
def q_selective_uplift(spark, sf):
    """The calibrated prediction only in the cells that gained by it on the other folds."""
    out = residuals.selective_uplift(oof_rows(spark, sf), "oof_pred")
    return rounded(out.select(C.ID_COL, "fold", "chosen", "uplifted"))


def _promotion_sql(replicates: int = 100, seed: int = 42) -> str:
    steps = residuals._poisson_steps()
    w = " + ".join(f"(u >= {s})::INT" for s in steps)
    return O.with_ctes(*_oof_ctes(), "pg AS (SELECT SaleID, abs(price - other_pred) - abs(price - oof_pred) AS g FROM oo WHERE price IS NOT NULL)",
        f"""pw AS (SELECT g, b, {w} AS w FROM (SELECT g, b, CAST('0x' || substr(md5(SaleID || ':{seed}:' || ((b - 1) // 4)), 8 * ((b - 1) % 4) + 1, 8) AS BIGINT) / 4294967296.0 AS u
  FROM pg, range(1, {replicates + 1}) t(b)) x UNION ALL SELECT g, 0, 1 FROM pg)""",
        "pr AS (SELECT b, sum(w) AS n, sum(w * g) / sum(w) AS gain FROM pw WHERE w > 0 GROUP BY b)",
        """po AS (SELECT max(CASE WHEN b = 0 THEN n END) AS n_rows, max(CASE WHEN b = 0 THEN gain END) AS gain, quantile_cont(CASE WHEN b > 0 THEN gain END, 0.025) AS low,
  quantile_cont(CASE WHEN b > 0 THEN gain END, 0.975) AS high, avg(CASE WHEN b > 0 THEN (gain > 0)::INT::DOUBLE END) AS better FROM pr)""") + f"""
SELECT CAST(n_rows AS BIGINT) AS n_rows, {r('gain')} AS gain, {r('low')} AS low, {r('high')} AS high, {r('better')} AS better, better >= 0.95 AND gain > 0 AS promote FROM po"""


@query("promote_model", _promotion_sql())
def q_promote_model(spark, sf):
    """Paired Poisson bootstrap: may the model encoding replace the brand encoding?"""
    out = residuals.promote_model(oof_rows(spark, sf), "other_pred", "oof_pred")
    return rounded(out.select(F.col("rows").alias("n_rows"), "gain", "low", "high", "better", "promote"))



# ===================================================================== flagship
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """listings -> default feature frame (counts, group statistics, dates,
    power) -> repeated stratified folds (one repeat) -> strict out-of-fold
    smoothed brand/model price means."""
    train, _ = fixture.split_train_test(listings(spark, sf))
    feats = feature_frame.build_train_features(train, steps=(*feature_frame.DEFAULT_STEPS, "power_age", "age_detail"))
    plan = folds.stratified_assign(feats, n_splits=5, repeats=1, seed=42, price_bins=5)
    rows = feats.join(plan.select(C.ID_COL, "fold"), C.ID_COL)
    oof = encode.build_oof_price_proxy_features(rows, "fold", 5, C.TARGET_COL, ("brand", "model"), SMOOTH)
    return rounded(oof.select(C.ID_COL, "fold", "brand", "model", "brand_count", "model_count",
                              "brand_power_mean", "car_age_years", "power_per_age_year",
                              "brand_price_mean", "model_price_mean"))
