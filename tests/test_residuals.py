"""Calibration, error slices, uplift and promotion on small tables."""

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from foldframe.operators import residuals

COLS = "SaleID long, price double, fold int, car_age_years double, power double, brand string, oof_pred double"


def oof(spark, change=None, n=400):
    r = random.Random(3)
    rows = []
    for i in range(n):
        p = r.uniform(500, 9000)
        rows.append([i, p * r.uniform(0.7, 1.4) + 200, i % 4 + 1, r.choice([None, 0.5, 2.0, 9.0]), r.choice([0.0, 80.0, 400.0]), r.choice("abc"), p])
    rows[7][1], rows[8][6] = None, None
    if change:
        change(rows)
    return spark.createDataFrame([tuple(x) for x in rows], COLS)


@pytest.mark.parametrize("kind", ["additive", "ratio"])
def test_no_row_is_corrected_by_its_own_fold(spark, kind):
    def spoil(rows):
        for x in rows:
            if x[2] == 2 and x[1] is not None:
                x[1] *= 50

    plain = {r.SaleID: r.correction for r in residuals.calibrate(oof(spark), "oof_pred", kind).collect()}
    spoilt = {r.SaleID: r.correction for r in residuals.calibrate(oof(spark, spoil), "oof_pred", kind).collect()}
    assert len(plain) == 400 and all(v is not None for v in plain.values())
    own = [i for i in plain if i % 4 + 1 == 2]
    assert all(plain[i] == spoilt[i] for i in own)
    assert any(plain[i] != spoilt[i] for i in plain if i % 4 + 1 != 2)


def test_corrections_shrink_toward_the_cell_above_and_unseen_cells_take_it(spark):
    rows = [(i, 100.0 + 10 * (i % 5), i % 2 + 1, 2.0, 80.0, "a", 100.0) for i in range(20)]
    fitted = residuals.fit_calibration(spark.createDataFrame(rows, COLS), "oof_pred", buckets=2, shrink=10.0)
    new = [(1, None, 0, 2.0, 80.0, "a", 100.0), (2, None, 0, None, 400.0, "a", 100.0), (3, None, 0, 2.0, 80.0, "a", 1e6)]
    got = {r.SaleID: r.calibrated for r in fitted.apply(spark.createDataFrame(new, COLS), "oof_pred").collect()}
    m = median(10.0 * (i % 5) for i in range(20))  # every cell holds the same rows, so shrinking changes nothing
    assert got == {1: 100 + m, 2: 100 + m, 3: 1e6 + m}
    with pytest.raises(ValueError):
        residuals.fit_calibration(spark.createDataFrame(rows, COLS), "oof_pred", "other")
    mixed = rows[:12] + [(100 + i, 400.0, i % 2 + 1, 9.0, 80.0, "a", 100.0) for i in range(4)]
    part = residuals.fit_calibration(spark.createDataFrame(mixed, COLS), "oof_pred", buckets=2, shrink=4.0)
    cell = {r.key: r.by_fold[0] for r in part.tables["cell2"].collect()}
    up = {r.key: r.by_fold[0] for r in part.tables["cell1"].collect()}["b0"]
    assert cell["b0|8y_plus"] == pytest.approx((4 * 300.0 + 4 * up) / 8)


def test_slices_add_up(spark):
    got = residuals.error_slices(oof(spark), "oof_pred").collect()
    whole = next(r for r in got if r.slice == "")
    errors = [abs(r.oof_pred - r.price) for r in oof(spark).collect() if r.price is not None and r.oof_pred is not None]
    assert whole.n == len(errors) == 398 and whole.mae == pytest.approx(sum(errors) / len(errors)) and whole.share == 1.0
    assert whole.within == [sum(e <= x for e in errors) for x in residuals.ERROR_EDGES]
    assert whole.p90_below == next(x for x in residuals.ERROR_EDGES if sum(e <= x for e in errors) >= 0.9 * len(errors))
    for name in ("age_bin", "brand", "power_bin|age_bin", "age_bin|power_bin"):
        part = [r for r in got if r.slice == name]
        assert not part or sum(r.n for r in part) == whole.n
    assert {r.slice for r in got} >= {"", "age_bin", "brand", "price_band"}
    assert residuals.error_slices(oof(spark).where("false"), "oof_pred").count() <= 1


def test_uplift_takes_the_cells_that_gain_elsewhere(spark):
    """In cell `x` the calibrated prediction is right, in `y` wrong; fold 1 alone tells otherwise."""
    rows = []
    for i in range(80):
        cell, fold = "xy"[i % 2], i % 4 + 1
        good = (cell == "x") != (fold == 1 and i % 2 == 1)
        rows.append((i, 100.0, fold, 90.0, 100.0 if good else 50.0, cell))
    table = spark.createDataFrame(rows, "SaleID long, price double, fold int, oof_pred double, calibrated double, cell string")
    chosen = {(r.fold, r.cell) for r in residuals.uplift_choices(table, "oof_pred", F.col("cell")).collect()}
    assert chosen == {(f, "x") for f in (1, 2, 3, 4)}
    assert residuals.uplift_choices(table, "oof_pred", F.col("cell"), margin=100.0).count() == 0
    out = residuals.selective_uplift(oof(spark), "oof_pred")
    assert out.count() == 400
    for r in out.collect():
        assert r.uplifted == (r.calibrated if r.chosen else r.oof_pred)


def test_promotion_is_paired_and_weights_are_poisson(spark):
    rows = spark.range(4000).select(F.col("id").alias("SaleID"), F.lit(100.0).alias("price"), F.lit(80.0).alias("old"), (F.lit(90.0) - F.col("id") % 3).alias("new"))
    r = residuals.promote_model(rows, "old", "new", replicates=40).first()
    assert r.rows == 4000 and r.gain == pytest.approx(9.0, abs=0.01) and r.low <= r.gain <= r.high and r.better == 1.0 and r.promote
    back = residuals.promote_model(rows, "new", "old", replicates=40).first()
    assert back.better == 0.0 and not back.promote
    same = residuals.promote_model(rows, "old", "old", replicates=8).first()
    assert same.gain == 0.0 and not same.promote
    w = Counter(x.w for x in residuals.with_replicates(rows.select("SaleID"), "SaleID", 10, 1).collect())
    assert sum(w.values()) == 40_000 and w[0] / 40_000 == pytest.approx(0.3679, abs=0.01) and sum(k * v for k, v in w.items()) / 40_000 == pytest.approx(1.0, abs=0.02)


def test_medians_without_each_fold_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3]), rng.choice([1.5, rng.gauss(0, 9), float("nan")]), f"b{i % 2}", f"b{i % 2}|x{i % 3}", f"b{i % 2}|x{i % 3}|y") for i in range(400)]
    df = spark.createDataFrame(rows, "fold int, v double, cell1 string, cell2 string, cell3 string")
    got = {(r["level"], r["key"], r["g"]): (r["m"], r["n"]) for r in residuals._medians_without(df).collect()}
    want = {}
    for g in (0, 1, 2, 3):
        for level in (0, 1, 2, 3):
            for key in {"" if level == 0 else r[level + 1] for r in rows}:
                own = [r[1] for r in rows if r[0] != g and (level == 0 or r[level + 1] == key)]
                want[level, key, g] = (median([v for v in own if v == v]), len(own))
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)


def test_bootstrap_rows_are_copied_for_blocks_of_replicates_only(spark):
    rows = spark.createDataFrame([(1, 2.0), (None, 3.0)], "SaleID long, g double")
    blocks = residuals.with_blocks(rows, "SaleID", 100, 42).collect()
    assert len(blocks) == 2 * 26
    assert all(r.w0 + r.w1 + r.w2 + r.w3 == (r.block < 0) for r in blocks if r.SaleID is None)
