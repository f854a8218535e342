"""DuckDB text of the same computations, for the correctness oracle.

These are plain SQL fragments (CTE bodies and expression templates) that the
registry composes per query; they mirror the Spark operators' semantics.
"""

from __future__ import annotations

from ..sources.fixture import LISTINGS_SQL


def clip0(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN 0.0 ELSE {x} END)"


def age_bin(x: str) -> str:
    a = clip0(x)
    return (f"(CASE WHEN {x} IS NULL THEN '__AGE_MISSING__' WHEN {a} <= 1 THEN '0_1y' "
            f"WHEN {a} <= 3 THEN '1_3y' WHEN {a} <= 5 THEN '3_5y' WHEN {a} <= 8 THEN '5_8y' "
            f"ELSE '8y_plus' END)")


def power_bin(x: str) -> str:
    p = f"(CASE WHEN {x} < 0 THEN 0.0 WHEN {x} > 600 THEN 600.0 ELSE {x} END)"
    return (f"(CASE WHEN {x} IS NULL THEN '__POWER_MISSING__' WHEN {p} <= 0 THEN '0' "
            f"WHEN {p} <= 60 THEN '1_60' WHEN {p} <= 90 THEN '60_90' WHEN {p} <= 120 THEN '90_120' "
            f"WHEN {p} <= 150 THEN '120_150' WHEN {p} <= 200 THEN '150_200' "
            f"WHEN {p} <= 300 THEN '200_300' ELSE '300_600' END)")


def power_bin_code(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL OR {x} <= -1 THEN NULL WHEN {x} <= 0 THEN 0.0 "
            f"WHEN {x} <= 60 THEN 1.0 WHEN {x} <= 90 THEN 2.0 WHEN {x} <= 120 THEN 3.0 "
            f"WHEN {x} <= 150 THEN 4.0 WHEN {x} <= 200 THEN 5.0 WHEN {x} <= 300 THEN 6.0 "
            f"WHEN {x} <= 600 THEN 7.0 ELSE NULL END)")


def freq_bin(x: str) -> str:
    return (f"(CASE WHEN {x} IS NULL THEN '__FREQ_MISSING__' WHEN {x} <= 1 THEN 'f1' "
            f"WHEN {x} <= 2 THEN 'f2' WHEN {x} <= 5 THEN 'f3_5' WHEN {x} <= 10 THEN 'f6_10' "
            f"WHEN {x} <= 20 THEN 'f11_20' WHEN {x} <= 50 THEN 'f21_50' ELSE 'f51_plus' END)")


def compact_date(x: str) -> str:
    return (f"CAST(try_strptime(trim(regexp_replace(CAST({x} AS VARCHAR), '\\.0$', '')), '%Y%m%d') AS DATE)")


def cat_text(col: str) -> str:
    t = f"trim(CAST({col} AS VARCHAR))"
    if col == "notRepairedDamage":
        return (f"coalesce(CASE WHEN {t} IN ('-', '') THEN NULL WHEN {t} = '0.0' THEN '0' "
                f"WHEN {t} = '1.0' THEN '1' ELSE {t} END, '__MISSING__')")
    return f"coalesce(CASE WHEN {t} IN ('', 'nan', 'NaN') THEN NULL ELSE {t} END, '__MISSING__')"


def sdiv(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END)"


# Row-local base over a listing source: F1 (power clip + flags) and D2 dates.
def base_cte(src: str = "listings", name: str = "base", power_bin_code_col: bool = False) -> str:
    pb = f", {power_bin_code('power_c')} AS power_bin" if power_bin_code_col else ""
    return f"""
{name}_raw AS (
  SELECT *, {compact_date('regDate')} AS reg_d, {compact_date('creatDate')} AS cre_d,
         CAST(CASE WHEN power < 0 OR power > 600 THEN 1 ELSE 0 END AS INTEGER) AS power_outlier_flag,
         CASE WHEN power < 0 THEN 0.0 WHEN power > 600 THEN 600.0 ELSE power END AS power_c
  FROM {src}),
{name} AS (
  SELECT * EXCLUDE (power, power_c, reg_d, cre_d), power_c AS power,
         CAST(CASE WHEN power_c = 0 THEN 1 ELSE 0 END AS INTEGER) AS power_is_zero{pb},
         year(reg_d) AS reg_year, month(reg_d) AS reg_month, day(reg_d) AS reg_day,
         isodow(reg_d) - 1 AS reg_weekday,
         year(cre_d) AS create_year, month(cre_d) AS create_month, day(cre_d) AS create_day,
         isodow(cre_d) - 1 AS create_weekday,
         datediff('day', reg_d, cre_d) AS car_age_days,
         datediff('day', reg_d, cre_d) / 365.25 AS car_age_years
  FROM {name}_raw)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join([LISTINGS_SQL.strip()] + [c.strip() for c in ctes])
