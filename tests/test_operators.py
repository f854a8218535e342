"""Hand-written frames for the semantic traps (null groups, single-row std,
bin edges, illegal dates, unseen keys, fold contracts, blend grid)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldframe import config as C
from foldframe.config import Encodings, Segment
from foldframe.functions.dates import age_bin, parse_compact_date, power_bin, power_bin_code
from foldframe.functions.targets import inverse_target, transform_target
from foldframe.operators import blend, clean, encode, features, folds, keyed, learners, ml, weights
from foldframe.operators.metrics import exact_quantiles
from foldframe.operators.quantiles import grouped_quantiles
from foldframe.sources import io
from foldframe.operators.ranking import global_rank, price_quantile_bin


def test_missing_tokens_and_damage(spark):
    df = spark.createDataFrame([(1, t, 1.0) for t in ["", " ", "nan", "NaN", "None", "NULL", "-", "0.0", "x"]],
                               "SaleID long, notRepairedDamage string, v double")
    out = clean.clean_not_repaired_damage(clean.normalize_missing_values(df))
    vals = [r[0] for r in out.select("notRepairedDamage").collect()]
    assert vals == [None] * 7 + ["0.0", "x"]
    cats = clean.normalize_categorical_columns(df, ["notRepairedDamage"]).collect()
    assert [r["notRepairedDamage"] for r in cats][-2:] == ["0", "x"]


def test_compact_dates(spark):
    df = spark.createDataFrame([("20070101",), ("20070011",), ("20070230",), ("2016123",), ("20070101.0",), (None,)],
                               "d string")
    got = [r[0] for r in df.select(parse_compact_date("d").cast("string")).collect()]
    assert got == ["2007-01-01", None, None, None, "2007-01-01", None]


def test_bin_edges(spark):
    df = spark.createDataFrame([(x,) for x in [-5.0, 0.0, 1.0, 1.0001, 3.0, 5.0, 8.0, 8.5, None]], "a double")
    got = [r[0] for r in df.select(age_bin("a")).collect()]
    assert got == ["0_1y", "0_1y", "0_1y", "1_3y", "1_3y", "3_5y", "5_8y", "8y_plus", C.AGE_MISSING]
    p = spark.createDataFrame([(x,) for x in [-1.0, 0.0, 60.0, 60.5, 600.0, 700.0, None]], "p double")
    assert [r[0] for r in p.select(power_bin("p")).collect()] == ["0", "0", "1_60", "60_90", "300_600", "300_600",
                                                                     C.POWER_MISSING]
    assert [r[0] for r in p.select(power_bin_code("p")).collect()] == [None, 0.0, 1.0, 2.0, 7.0, None, None]


def test_count_encoding_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5.0)], "SaleID long, model double")
    out = {r["SaleID"]: r["model_count"] for r in features.add_count_encoding(df, ["model"]).collect()}
    assert out == {1: 2.0, 2: 2.0, 3: 1.0}


def test_model_age_backoff_single_row_std(spark):
    rows = [(i, 1.0, 1, 10.0 * i, 5.0, 0.5) for i in range(1, 4)] + [(9, 2.0, 1, 50.0, 7.0, 9.0)]
    df = spark.createDataFrame(rows, "SaleID long, model double, brand long, power double, kilometer double, "
                                     "car_age_years double")
    df = features.add_count_encoding(df, ["model"])
    out = {r["SaleID"]: r for r in features.add_model_age_group_stats(df, min_count=2).collect()}
    # model 2 has one row: group std NULL -> model std NULL -> brand std
    brand_std = float(np.std([10, 20, 30, 50], ddof=1))
    assert math.isclose(out[9]["model_age_power_std"], brand_std)
    assert math.isclose(out[1]["model_age_power_mean"], 20.0)


def test_global_rank_ties_and_quantile_bins(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(1, 31)], "SaleID long, price double")
    ranks = global_rank(df, ["price", "SaleID"], "rk", num_partitions=5).orderBy("rk").collect()
    assert [r["rk"] for r in ranks] == list(range(1, 31))
    assert [(r["price"], r["SaleID"]) for r in ranks] == sorted((r["price"], r["SaleID"]) for r in ranks)
    bins = price_quantile_bin(df, "price", "SaleID", 5).groupBy("price_bin").count().collect()
    assert sorted(r["count"] for r in bins) == [6, 6, 6, 6, 6]


def test_exact_quantiles_match_numpy(spark):
    vals = [float(x) for x in np.random.default_rng(1).integers(0, 50, 101)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    q = exact_quantiles(df, "v", [0.5, 0.8, 0.99])
    for k, v in q.items():
        assert math.isclose(v, float(np.quantile(vals, k)))


def test_fold_contracts(spark):
    df = spark.createDataFrame([(i, float(i * 7 % 101), float(i % 9), float(i % 4)) for i in range(1, 201)],
                               "SaleID long, price double, car_age_years double, model double")
    plan = folds.stratified_assign(df, n_splits=5, repeats=2, seed=42, price_bins=5).collect()
    for rep in (1, 2):
        ids = [r["SaleID"] for r in plan if r["repeat"] == rep]
        assert sorted(ids) == list(range(1, 201))
    by = {}
    for r in plan:
        by.setdefault((r["repeat"], r["strat_label"]), []).append(r["fold"])
    for fs in by.values():
        sizes = [fs.count(f) for f in range(1, 6)]
        assert max(sizes) - min(sizes) <= 1


def test_oof_encoding_ignores_own_target(spark):
    rows = [(i, "b%d" % (i % 3), float(i)) for i in range(1, 41)]
    df = spark.createDataFrame(rows, "SaleID long, brand string, price double")
    df = folds.kfold_assign(df, 4, 42)
    a = {r["SaleID"]: r["brand_price_mean"] for r in
         encode.build_oof_price_proxy_features(df, "fold", 4, columns=("brand",)).collect()}
    df2 = df.withColumn("price", F.when(F.col("SaleID") == 7, F.lit(1e6)).otherwise(F.col("price")))
    b = {r["SaleID"]: r["brand_price_mean"] for r in
         encode.build_oof_price_proxy_features(df2, "fold", 4, columns=("brand",)).collect()}
    assert math.isclose(a[7], b[7])


def test_smoothing_zero_and_unseen_key(spark):
    fit = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 40.0)], "k string, y double")
    app = spark.createDataFrame([("a",), ("z",)], "k string")
    out = {r["k"]: r["enc"] for r in encode.smoothed_target_encoding(
        fit, app, F.col("k"), F.col("y"), 0.0, "enc").collect()}
    assert out == {"a": 15.0, "z": pytest.approx(70.0 / 3)}


def test_backoff_encodings(spark):
    fit = spark.createDataFrame([("m1", "b1", 100.0, 5.0, float(i)) for i in range(3)] +
                                [("m2", "b1", 100.0, 5.0, 30.0)],
                                "model string, brand string, power double, car_age_years double, price double")
    stats = encode.fit_stats(fit, F.col("price"), encode.key_expressions())
    cfg = Encodings(("model_backoff_target_mean", "model_power_age_backoff_target_mean", "model_low_freq_flag"), 0.0, 3)
    out = {r["model"]: r for r in encode.apply_encodings(fit.select("model", "brand", "power", "car_age_years"),
                                                         stats, cfg).collect()}
    assert out["m1"]["model_backoff_target_mean"] == pytest.approx(1.0)
    assert out["m2"]["model_backoff_target_mean"] == pytest.approx(33.0 / 4)  # brand mean
    assert out["m2"]["model_low_freq_flag"] == 1.0


def test_target_roundtrip(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (1234.5,)], "y double")
    for mode in ("log1p", "sqrt", "pow075", "price"):
        back = [r[0] for r in df.select(inverse_target(transform_target("y", mode), mode)).collect()]
        assert back == pytest.approx([0.0, 5.0, 1234.5])


def test_weights_normalised(spark):
    df = spark.createDataFrame([(i, float(i), float(i % 6)) for i in range(1, 51)],
                               "SaleID long, price double, car_age_years double")
    out = weights.build_sample_weights(df, weights.WEIGHTINGS["legacy"])
    assert out.agg(F.avg("sample_weight")).first()[0] == pytest.approx(1.0)
    assert weights.cells_from_text("Q5:age_missing, Q4|3_5y") == (("Q5", C.AGE_MISSING), ("Q4", "3_5y"))
    for bad in ("", "Q5", "Q5:"):
        with pytest.raises(ValueError):
            weights.cells_from_text(bad)


def test_weight_grid_and_rounding(spark):
    g = blend.weight_grid(spark, 3, 0.25).orderBy("cand_id").collect()
    assert len(g) == blend.grid_size(3, 0.25) == 15
    assert all(abs(sum(r["w"]) - 1) < 1e-12 for r in g)
    units = [tuple(r["units"]) for r in g]
    assert units == sorted(units) and [r["cand_id"] for r in g] == list(range(15))
    given = [([0.33, 0.33, 0.34], [3, 3, 4]), ([0.25, 0.25, 0.5], [2, 3, 5]), ([0.0, 0.0, 0.0], [3, 3, 4]), ([2.0, -1.0, 1.0], [5, 0, 5])]
    df = spark.createDataFrame([(w, u) for w, u in given], "w array<double>, want array<int>")
    assert all(r["got"] == r["want"] for r in df.select("want", blend.rounded_units(F.col("w"), 10).alias("got")).collect())
    with pytest.raises(ValueError):
        blend.units_of(0.3)


def test_neighbourhoods_and_local_search(spark):
    centre = spark.createDataFrame([([2, 0, 2],)], "units array<int>")
    box = {tuple(r[0]) for r in blend.box_neighbours(centre, 3, 4, 1).collect()}
    assert box == {(a, b, 4 - a - b) for a in (1, 2, 3) for b in (0, 1) if 4 - a - b >= 0}
    moves = {tuple(r[0]) for r in blend.transfer_neighbours(centre, 3, 2).collect()}
    assert moves == {(2, 0, 2), (1, 1, 2), (0, 2, 2), (1, 0, 3), (0, 0, 4), (3, 0, 1), (4, 0, 0), (2, 1, 1), (2, 2, 0)}
    rows = [(i, float(100 + i), [float(100 + i + (i % 5)), float(100 + i - (i % 3)), 80.0], i % 3 + 1) for i in range(60)]
    df = spark.createDataFrame(rows, "SaleID long, price double, preds array<double>, fold int")
    found = {r["meta_fold"]: r["mae"] for r in blend.optimize(df, 3, 0.1, "fold", radius=2).collect()}
    grid = blend.weight_grid(spark, 3, 0.1)
    for f in (0, 1, 2, 3):
        best = blend.search_best_weights(df.where(F.col("fold") != f), grid, 1).first()["mae"]
        assert found[f] <= best + 1e-9


def test_oof_tables_without_common_rows_raise(spark):
    one = spark.createDataFrame([(1, 2.0, 3.0)], "SaleID long, price double, oof_pred double")
    with pytest.raises(ValueError):
        blend.load_oof_matrix([("a", one), ("b", one.withColumn("SaleID", F.lit(2).cast("long")))])


def test_blend_beats_single_models(spark):
    rows = [(i, float(100 + i), [float(100 + i + (i % 5)), float(100 + i - (i % 3)), 50.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "SaleID long, price double, preds array<double>")
    top = blend.search_best_weights(df, blend.weight_grid(spark, 3, 0.1), top_k=3).orderBy("rank").collect()
    singles = [blend.mae_for_weights(df, w) for w in np.eye(3)]
    assert top[0]["mae"] <= min(singles) + 1e-12
    assert top[0]["mae"] <= top[1]["mae"]
    brute = min(float(np.mean([abs(r[1] - max(np.dot(r[2], w), 0)) for r in rows]))
                for w in ((a / 10, b / 10, (10 - a - b) / 10) for a in range(11) for b in range(11 - a)))
    assert top[0]["mae"] == pytest.approx(brute)


def test_meta_cv_single_pass_equals_per_fold_search(spark):
    rows = [(i, float(100 + i), [float(100 + i + (i % 5)), float(100 + i - (i % 3)), 80.0], i % 3 + 1)
            for i in range(45)]
    df = spark.createDataFrame(rows, "SaleID long, price double, preds array<double>, fold int")
    choices, _ = blend.run_meta_cv(df, blend.weight_grid(spark, 3, 0.25), "fold")
    got = {r["meta_fold"]: r["cand_id"] for r in choices.collect()}
    for f in (1, 2, 3):
        best = blend.search_best_weights(df.where(F.col("fold") != f), blend.weight_grid(spark, 3, 0.25), top_k=1).first()
        assert got[f] == best["cand_id"]


def test_exact_medians_and_codes(spark):
    df = spark.createDataFrame([(1, 1.0, "b"), (2, None, "a"), (3, 4.0, None), (4, 10.0, "b")],
                               "SaleID long, x double, c string")
    assert ml.exact_medians(df, ["x"]) == {"x": 4.0}
    codes = {r["value"]: r["code"] for r in ml.fit_ordinal_codes(df, ["c"]).collect()}
    assert codes == {"__MISSING__": 0.0, "a": 1.0, "b": 2.0}


def test_sized_join_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id long, k string")
    st = spark.createDataFrame([(None, 5.0), ("x", 7.0)], "k string, v double")
    out = {r["id"]: r["v"] for r in keyed.attach(df, st, ["k"]).collect()}
    assert out == {1: 5.0, 2: 7.0}


def listing_rows(spark, n=400):
    rows = [(i, float(100 + 37 * (i % 23) + i), f"b{i % 5}", float(i % 12), float(i % 7)) for i in range(n)]
    return spark.createDataFrame(rows, "SaleID long, price double, brand string, car_age_years double, x double")


def test_nothing_is_routed_below_the_minimal_segment(spark):
    df = listing_rows(spark)
    plan = df.select("SaleID", F.lit(1).alias("repeat"), (F.col("SaleID") % 2 + 1).cast("int").alias("fold"))
    for least, routed in ((20, True), (10_000, False)):
        preds, per_fold = ml.cross_validate(df, plan, [], [], learners.GroupMean("brand"), Segment(True, 0.3, least))
        rows = per_fold.collect()
        assert all((r["routed_count"] > 0) == routed for r in rows)
        if not routed:
            assert all(r["mae"] == r["global_mae"] for r in rows) and preds.where("routed or pred != global_pred").count() == 0
    with pytest.raises(ValueError):
        ml.cross_validate(df, plan.where("SaleID > 5"), [], [], learners.GroupMean("brand"))


def test_saved_model_predicts_alike_and_no_categories_are_fine(spark, tmp_path):
    df = listing_rows(spark).withColumns({"model": F.col("brand"), "power": F.col("x")})
    how = {"enc": Encodings(("brand_target_mean",), 5.0)}
    for cats in ([], ["brand"]):
        model = ml.fit_model(df, ["x", "car_age_years"], cats, learners.BoostedTrees(trees=2, depth=2), **how)
        model.save(str(tmp_path / f"m{len(cats)}"))
        back = ml.FittedModel.load(spark, str(tmp_path / f"m{len(cats)}"))
        a, b = ({r["SaleID"]: r["prediction"] for r in m.predict(df).collect()} for m in (model, back))
        assert a == b and len(a) == 400
    with pytest.raises(ValueError):
        learners.depth_for_leaves(1 << 40)


def test_grouped_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(None if k == 3 else f"k{k}", float(v) if i % 11 else None) for k in range(4) for i, v in enumerate(rng.integers(0, 50 if k else 10**9, 700 * (k + 1)))]
    got = {(r["k"], r["prob"]): r["value"] for r in grouped_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], ["v"], [0.0, 0.5, 0.83, 1.0]).collect()}
    for k in ("k0", "k1", "k2", None):
        v = [x for key, x in rows if key == k and x is not None]
        for p in (0.0, 0.5, 0.83, 1.0):
            assert got[k, p] == pytest.approx(np.quantile(v, p))


def raw_file(path, header, *rows):
    path.write_text("\n".join([header, *rows]) + "\n")
    return str(path)


def test_raw_reader_follows_the_header(spark, tmp_path):
    names = list(C.COMMON_REQUIRED_COLUMNS) + ["price", "v_0"]
    cells = {n: str(i % 2) for i, n in enumerate(names)} | {"SaleID": "7", "brand": "3", "model": "11", "regDate": "20040402", "creatDate": "20160404",
                                                           "price": "120", "kilometer": "12.5", "v_0": "1.5", "bodyType": ""}
    swapped = [n if n not in ("brand", "model") else {"brand": "model", "model": "brand"}[n] for n in names]
    for order in (names, swapped):
        df = io.load_train_data(spark, raw_file(tmp_path / "x.csv", " ".join(order), " ".join(cells[n] for n in order)))
        row = df.first()
        assert (row["brand"], row["model"], row["price"], row["bodyType"], row["v_0"]) == (3, 11.0, 120.0, None, 1.5)
    no_price = [n for n in names if n != "price"]
    file = raw_file(tmp_path / "y.csv", " ".join(no_price), " ".join(cells[n] for n in no_price))
    for check in (True, False):
        with pytest.raises(ValueError):
            io.load_train_data(spark, file, check)
    assert io.load_test_data(spark, file).count() == 1
    few = [n for n in names if n != "gearbox"]
    with pytest.raises(ValueError):
        io.load_train_data(spark, raw_file(tmp_path / "z.csv", " ".join(few), " ".join(cells[n] for n in few)))
    whole = " ".join(cells[n] for n in names)
    with pytest.raises(ValueError):
        io.load_train_data(spark, raw_file(tmp_path / "s.csv", " ".join(names), whole, whole.rsplit(" ", 2)[0]))
    with pytest.raises(ValueError):
        io.load_data(spark, raw_file(tmp_path / "r.csv", " ".join(names), whole.replace("12.5", "99")), file)


def test_plan_summary(spark):
    plan = spark.createDataFrame([(i, r, i % 3 + 1, "a" if i < 7 else "b") for r in (1, 2) for i in range(12)], "SaleID long, repeat int, fold int, strat_label string")
    assert tuple(folds.plan_summary(plan).first()) == (6, 2, 5)
    assert tuple(folds.plan_summary(plan.drop("strat_label")).first()) == (6, 1, 12)


def test_strict_encodings_have_no_part_of_the_row_or_the_outer_fold(spark):
    """T14 strict: own targets and those of the outer fold do not reach a fit row."""
    import random

    from pyspark.sql import functions as F

    from foldframe.config import Encodings
    from foldframe.operators import encode

    r = random.Random(1)
    base = [(i, "abc"[i % 3], "mn"[i % 2], 2.0, 80.0, i % 5 + 1, float(r.randint(100, 900))) for i in range(200)]
    cols = "SaleID long, brand string, model string, car_age_years double, power double, fold int, price double"
    outputs = ("brand_target_mean", "model_backoff_target_mean")

    def strict(rows):
        df = spark.createDataFrame(rows, cols)
        stats = encode.fit_stats(df, F.col("price"), encode.keys_for(outputs), "fold")
        return {(x.outer, x.SaleID): (x.role, x.brand_target_mean, x.model_backoff_target_mean) for x in encode.strict_frames(df, stats, Encodings(outputs), "fold", 5).collect()}

    plain = strict(base)
    spoilt = strict([(*x[:6], x[6] * 1000 if x[5] in (2, 4) else x[6]) for x in base])
    assert len(plain) == 1000 and plain[2, 1][0] == "valid" and plain[3, 1][0] == "fit"
    for (outer, i), v in plain.items():
        hidden = {outer, i % 5 + 1}
        same = v[1:] == pytest.approx(spoilt[outer, i][1:])
        assert same == ({2, 4} <= hidden)


def test_continuous_weights_are_no_worse_than_the_grid(spark):
    import random

    from pyspark.sql import functions as F

    from foldframe.operators import blend

    r = random.Random(4)
    rows = []
    for i in range(400):
        y = r.uniform(10, 1000)
        rows.append((i, y if i else None, [y * r.uniform(0.8, 1.3), y + r.gauss(0, 80), r.uniform(0, 900)]))
    df = spark.createDataFrame(rows, "SaleID long, price double, preds array<double>")
    w, mae, rounds = blend.continuous_weights(df, 3)
    assert abs(sum(w) - 1) < 1e-9 and min(w) >= 0 and rounds < 100
    assert mae == pytest.approx(blend.mae_for_weights(df, w))
    known = df.where(F.col("price").isNotNull())
    grid = blend.search_best_weights(known, blend.weight_grid(spark, 3, 0.025), 1).first()
    assert mae <= grid.mae * (1 + 1e-6)
    one, _, _ = blend.continuous_weights(spark.createDataFrame([(i, 5.0 * i, [5.0 * i, 9.0 * i]) for i in range(1, 50)], "SaleID long, price double, preds array<double>"), 2)
    assert one[0] == pytest.approx(1.0, abs=1e-6)


def test_samples_splits_and_folds_without_a_sort(spark, monkeypatch):
    import hashlib

    from pyspark.sql import functions as F

    from foldframe.operators import folds

    df = spark.range(3000).select(F.col("id").alias("SaleID"), (F.col("id") % 7).alias("x")).repartition(5)
    order = sorted(range(3000), key=lambda i: (hashlib.md5(f"{i}:42".encode()).hexdigest(), i))
    for margin in (100_000, 1):  # one step of digits, and down to single rows
        monkeypatch.setattr(folds, "MARGIN", margin)
        sample = folds.sample_rows(df, 123)
        assert {r.SaleID for r in sample.collect()} == set(order[:123])
        assert {r.SaleID for r in folds.train_valid_split(df, 0.1).where("split = 'valid'").collect()} == set(order[:300])
    assert "Sort" not in sample._jdf.queryExecution().executedPlan().toString() and "Exchange hashpartitioning" not in sample._jdf.queryExecution().executedPlan().toString()
    assert folds.sample_rows(df, 5000).count() == 3000
    last = folds.train_valid_split(df, 0.1, shuffle=False)
    assert {r.SaleID for r in last.where("split = 'valid'").collect()} == set(range(2700, 3000))
    assigned = {r.SaleID: r.fold for r in folds.kfold_assign(df, 5, 42).collect()}
    assert assigned == {i: k % 5 + 1 for k, i in enumerate(order)}


def test_worst_share_and_bundles_of_every_learner(spark, tmp_path):
    from foldframe.operators import learners, leafwise, metrics, ml

    for errors in ([5.0] * 30, [float(i) for i in range(57)], [1.0], [1.0, 1.0, 1.0, 9.0] * 10):
        df = spark.createDataFrame(list(enumerate(errors)), "id long, e double")
        got = {r.metric: r.value for r in metrics.error_report(df, "e", "id").collect()}
        worst = sorted(errors)[-max(1, int(len(errors) * 0.1)):]
        assert got["worst_10pct_abs_error_share"] == pytest.approx(sum(worst) / sum(errors))
    rows = spark.createDataFrame([(i, "ab"[i % 2], float(i % 5), 100.0 + 10 * (i % 5)) for i in range(80)], "SaleID long, brand string, x double, price double")
    for k, (learner, features) in enumerate([(learners.GroupMean("brand"), []), (leafwise.LeafwiseTrees(trees=2, leaves=4, min_rows=5), ["x"])]):
        model = ml.fit_model(rows, features, ["brand"] if features else [], learner)
        model.save(str(tmp_path / str(k)))
        before, after = ({r.SaleID: r.prediction for r in m.predict(rows).collect()} for m in (model, ml.FittedModel.load(spark, str(tmp_path / str(k)))))
        assert before == pytest.approx(after)
    with pytest.raises(ValueError):
        ml.learner("none of them")


def test_checks_are_observed_while_the_rows_are_written(spark, tmp_path):
    """One pass; a table that fails a check leaves nothing behind."""
    import os

    from foldframe import config as C
    from foldframe.plans import jobs

    names = [*C.COMMON_REQUIRED_COLUMNS, "price"]

    def file(name, change=None, rows=60, columns=names):
        lines = [" ".join(columns)]
        for i in range(rows):
            row = {c: "1" for c in columns} | {"SaleID": str(i), "regDate": "20100101", "creatDate": "20160101", "price": "900"}
            lines.append(" ".join((change or (lambda _, r: r))(i, row)[c] for c in columns))
        path = str(tmp_path / name)
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        return path

    good, test = file("good"), file("test", columns=names[:-1])
    train, _ = jobs.make_data(spark, good, test, str(tmp_path / "out"))
    assert train.count() == 60 and "_malformed" not in train.columns
    bad = {"price": file("a", lambda i, r: r | {"price": "-5"} if i == 3 else r), "gearbox": file("b", lambda i, r: r | {"gearbox": "7"}),
           "header": file("c", lambda i, r: r | {"price": "1 2"} if i == 4 else r), "no rows": file("d", rows=0), "target": file("e", columns=names[:-1])}
    for word, path in bad.items():
        with pytest.raises(ValueError, match=word):
            jobs.make_data(spark, path, test, str(tmp_path / f"out-{os.path.basename(path)}"))
        assert not os.path.exists(tmp_path / f"out-{os.path.basename(path)}" / "train")


def test_scratch_tables_of_a_run_are_deleted(spark):
    import os

    from foldframe import session

    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file://")
    assert os.path.exists(local)
    session.delete(spark, path)
    assert not os.path.exists(local) and os.path.basename(os.path.dirname(local)).startswith("run-")


def test_quantiles_count_a_row_once_however_often_a_probability_is_asked_for(spark):
    df = spark.range(11).selectExpr("cast(id as double) AS v")
    got = {(r["prob"]): r["value"] for r in grouped_quantiles(df, [], ["v"], [0.9, 0.5, 0.9]).collect()}
    assert got == {0.5: 5.0, 0.9: 9.0}


def test_raw_files_hold_region_codes_within_their_range(spark, tmp_path):
    import datetime

    from foldframe.plans import registry

    day, customers = datetime.date(1995, 3, 1), [7, 99_999, 100_000, 100_001, 450_000, 900_000]
    spark.createDataFrame([(c, 3, 900.0) for c in customers], "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(i, c, "F", 1000.0 + i, day) for i, c in enumerate(customers, 1)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(i, day, 20.0, 0.1, 0.1, 5.0) for i, *_ in orders]
    spark.createDataFrame(lines, "l_orderkey long, l_shipdate date, l_quantity double, l_discount double, l_tax double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert {r["name"] for r in registry.q_csv_roundtrip(spark, str(tmp_path)).collect()} == set(customers)


def test_a_key_with_few_groups_is_broadcast_beside_one_with_many(spark):
    rows = [(f"n{i}", "ab"[i % 2], float(i % 7)) for i in range(20_000)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "name string, brand string, v double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        st = keyed.KeyStatistics(df, {"name": F.col("name"), "brand": F.col("brand")}, ["v"], [("brand", "v")], ["name"])
        assert st.parts["name"].columns == ["kval", "count"]
        out = st.onto(df, "brand", {"m": "v_median", "c": "count"})
        assert "BroadcastHashJoin" in out._jdf.queryExecution().sparkPlan().toString()
        got = {r["brand"]: (r["m"], r["c"]) for r in out.select("brand", "m", "c").distinct().collect()}
        assert got == {"a": (3.0, 10_000.0), "b": (3.0, 10_000.0), None: (None, 1.0)}
        out = st.onto(df, "name", {"c": "count"})
        assert "BroadcastHashJoin" not in out._jdf.queryExecution().sparkPlan().toString()
        assert {r["c"] for r in out.select("c").distinct().collect()} == {1.0}
        assert st.onto(df.limit(0), "brand", {"c": "count"}).count() == 0
        none = keyed.KeyStatistics(df.limit(0), {"brand": F.col("brand")}, ["v"], [("brand", "v")])
        assert none.onto(df.limit(1), "brand", {"m": "v_median"}).collect()[0]["m"] is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
