"""Smoothed target encodings with back-off, fold-safe without a fold loop
(T1-T14).

Encoded value of a key = (sum_k + global_mean * s) / (n_k + s) over fit rows
with a non-null target; unseen key -> global mean.

Aggregate once (R2): every requested key is stacked into (key name, key value) pairs
and aggregated in a single pass to its totals and to the part of each fold that holds
it. The fitted table has one row per key, with the folds' parts as a map of at most
as many entries as there are folds. Rows join it by key alone, and "without fold g"
is the total minus entry g, taken at the row. Apply rows carry the fold that must not
count (`apply_fold`): their own one for out-of-fold validation rows, another for the
fit rows of a CV fold (T14), 0 for holdout and test rows. In the strict form of T14 a
fit row also leaves its own fold out, so no row has a part in its own encoding: the total
minus two entries of the same map.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import Encodings
from ..functions.dates import age_bin, power_bin
from ..functions.targets import scale, transform_target_for_encoding
from ..session import saved
from . import keyed

NO_FOLD = 0


def norm_key(c: str | Column) -> Column:
    """Trimmed text key, missing -> `__MISSING__`."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(x.cast("string")), F.lit(C.MISSING_CATEGORY))


def key_expressions(age_col: str = "car_age_years", power_col: str = "power") -> dict[str, Column]:
    """The key family used by the listing encodings."""
    ab = age_bin(age_col)
    pb = power_bin(power_col)
    return {
        "brand": norm_key("brand"),
        "model": norm_key("model"),
        "brand_age": F.concat(norm_key("brand"), F.lit("|"), ab),
        "model_age": F.concat(norm_key("model"), F.lit("|"), ab),
        "model_power_age": F.concat(norm_key("model"), F.lit("|"), pb, F.lit("|"), ab),
        "power_bin": pb,
        "power_age": F.concat(pb, F.lit("|"), ab),
    }


@dataclass
class FittedStats:
    """Fitted encoder state: per (key name, key value) the target sum, target count and
    row count over all fit rows and by fold, and the global mean without each fold
    (0: none left out) and without each pair of folds."""

    keys: DataFrame
    means: dict[int, float | None]
    key_exprs: dict[str, Column] = field(default_factory=dict)
    pair_means: dict[tuple[int, int], float | None] = field(default_factory=dict)

    def save(self, path: str) -> None:
        self.keys.write.mode("overwrite").parquet(f"{path}/keys")
        rows = [(int(g), m) for g, m in self.means.items()]
        self.keys.sparkSession.createDataFrame(rows, "fold int, mean double").write.mode("overwrite").parquet(f"{path}/means")

    @classmethod
    def load(cls, spark: SparkSession, path: str, key_exprs: dict[str, Column]) -> "FittedStats":
        means = {r["fold"]: r["mean"] for r in spark.read.parquet(f"{path}/means").collect()}
        return cls(spark.read.parquet(f"{path}/keys"), means, key_exprs)

    def mean_of(self, fold: Column) -> Column:
        """Global mean for the rows of `fold`: a literal map of one entry per fold."""
        pairs = [F.lit(x).cast(t) for g, m in self.means.items() for x, t in ((g, "int"), (m, "double"))]
        return F.try_element_at(F.create_map(*pairs), fold)

    def mean_of_pair(self, one: Column, two: Column) -> Column:
        """Global mean without two different folds: a literal map of an entry per pair."""
        if not self.pair_means:
            raise ValueError("statistics without folds have no pairs to leave out")
        pairs = [F.lit(x).cast(t) for (g, h), m in self.pair_means.items() for x, t in ((f"{g}|{h}", "string"), (m, "double"))]
        return F.try_element_at(F.create_map(*pairs), F.concat_ws("|", F.least(one, two), F.greatest(one, two)))


def fit_stats(fit: DataFrame, target: Column, key_exprs: dict[str, Column], fold_col: str | None = None) -> FittedStats:
    """One stacked aggregation over the fit rows, written to the shared scratch folder."""
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(NO_FOLD)
    pairs = F.array(*[F.struct(F.lit(n).alias("kname"), e.cast("string").alias("kval"))
                      for n, e in key_exprs.items()])
    stacked = fit.select(fold.alias("fold"), target.cast("double").alias("__t"), F.inline(pairs))
    part = stacked.groupBy("kname", "kval", "fold").agg(
        F.sum("__t").alias("s"), F.count("__t").alias("n"), F.count(F.lit(1)).alias("r"))
    entry = F.struct(F.col("fold"), F.struct(F.coalesce("s", F.lit(0.0)).alias("s"), "n", "r"))
    keys = part.groupBy("kname", "kval").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("r").alias("r"), F.map_from_entries(F.collect_list(entry)).alias("folds"))
    # one row per fold comes to the driver
    sums = {r["fold"]: (r["s"] or 0.0, r["n"]) for r in fit.select(fold.alias("fold"), target.cast("double").alias("__t"))
            .groupBy("fold").agg(F.sum("__t").alias("s"), F.count("__t").alias("n")).collect()}
    total, count = sum(s for s, _ in sums.values()), sum(n for _, n in sums.values())
    left = {NO_FOLD: (total, count)} | ({g: (total - s, count - n) for g, (s, n) in sums.items()} if fold_col else {})
    pairs = {(g, h): (total - sums[g][0] - sums[h][0], count - sums[g][1] - sums[h][1]) for g in sums for h in sums if g < h} if fold_col else {}
    means, pair_means = ({k: s / n if n else None for k, (s, n) in x.items()} for x in (left, pairs))
    return FittedStats(saved(keys, "encoder-keys"), means, key_exprs, pair_means)


def _attach_key(df: DataFrame, stats: FittedStats, name: str, prefix: str) -> DataFrame:
    """Sum, count and rows of the row's key without the fold in `__afold` and, where that
    column is there, the one in `__bfold`."""
    sub = stats.keys.where(F.col("kname") == name).select("kval", F.struct("s", "n", "r", "folds").alias("__k"))
    out = keyed.attach(df, sub, [(stats.key_exprs[name].cast("string"), "kval")])
    own = F.try_element_at("__k.folds", F.when(F.col("__afold") != NO_FOLD, F.col("__afold")))
    left = {x: F.col(f"__k.{x}") - F.coalesce(own[x], F.lit(0)) for x in ("s", "n", "r")}
    if "__bfold" in df.columns:
        other = F.try_element_at("__k.folds", F.when((F.col("__bfold") != NO_FOLD) & (F.col("__bfold") != F.col("__afold")), F.col("__bfold")))
        left = {x: c - F.coalesce(other[x], F.lit(0)) for x, c in left.items()}
    return out.withColumns({f"{prefix}_{x}": c for x, c in left.items()}).drop("__k")


def _with_fold(df: DataFrame, stats: FittedStats, fold: Column) -> DataFrame:
    out = df.withColumn("__afold", fold.cast("int"))
    return out.withColumn("__gmean", stats.mean_of(F.col("__afold")))


def _smoothed(prefix: str, smoothing: float) -> Column:
    n = F.coalesce(F.col(f"{prefix}_n"), F.lit(0))
    enc = (F.col(f"{prefix}_s") + F.col("__gmean") * F.lit(float(smoothing))) / (n + F.lit(float(smoothing)))
    return F.when(n > 0, enc).otherwise(F.col("__gmean"))


def _plain(key: str):
    return lambda cfg: _smoothed(f"__{key}", cfg.smoothing)


def _with_backoff(key: str, count: str, other):
    """Encoding of `key` where it has enough (`count`: n targets or r rows), else `other`."""
    return lambda cfg: F.when(F.coalesce(F.col(f"__{key}_{count}"), F.lit(0)) >= cfg.min_count,
                              _smoothed(f"__{key}", cfg.smoothing)).otherwise(other(cfg))


_model_or_brand = _with_backoff("model", "r", _plain("brand"))

# output column -> (keys that it reads, formula)
ENCODINGS = {
    "brand_target_mean": (("brand",), _plain("brand")),
    "brand_age_target_mean": (("brand_age",), _plain("brand_age")),
    "model_target_mean": (("model",), _plain("model")),
    "model_backoff_target_mean": (("model", "brand"), _model_or_brand),
    "model_power_age_backoff_target_mean": (("model", "brand", "model_power_age"), _with_backoff("model_power_age", "n", _model_or_brand)),
    "model_low_freq_flag": (("model",), lambda cfg: (F.coalesce(F.col("__model_r"), F.lit(0)) < cfg.rare_below).cast("double")),
    "model_age_target_mean": (("model", "brand", "model_age"), _with_backoff("model_age", "n", _model_or_brand)),
    "power_age_bin_target_mean": (("power_bin", "power_age"), _with_backoff("power_age", "n", _plain("power_bin"))),
}


def keys_for(outputs: Sequence[str]) -> dict[str, Column]:
    """The key expressions that the encodings in `outputs` read."""
    need = {k for o in outputs for k in ENCODINGS[o][0]}
    return {k: e for k, e in key_expressions().items() if k in need}


def apply_encodings(apply: DataFrame, stats: FittedStats, cfg: Encodings,
                    apply_fold: Column | None = None) -> DataFrame:
    """Append the encodings of `cfg` to `apply` (trainer semantics)."""
    _check_smoothing(cfg.smoothing)
    df = _with_fold(apply, stats, apply_fold if apply_fold is not None else F.lit(NO_FOLD))
    for name in keys_for(cfg.outputs):
        df = _attach_key(df, stats, name, f"__{name}")
    df = df.withColumns({o: ENCODINGS[o][1](cfg) for o in cfg.outputs})
    return df.drop(*[c for c in df.columns if c.startswith("__") and c not in apply.columns])


def apply_strict(apply: DataFrame, stats: FittedStats, cfg: Encodings, outer: Column, own: Column) -> DataFrame:
    """T14, strict: encodings of `apply` without the rows of the `outer` fold, which the
    model is validated on, and of the row's `own` fold. For validation rows, whose own fold
    is the outer one, that is the same as `apply_encodings`."""
    _check_smoothing(cfg.smoothing)
    df = apply.withColumns({"__afold": outer.cast("int"), "__bfold": own.cast("int")})
    two = F.col("__afold") != F.col("__bfold")
    df = df.withColumn("__gmean", F.when(two, stats.mean_of_pair(F.col("__afold"), F.col("__bfold"))).otherwise(stats.mean_of(F.col("__afold"))))
    for name in keys_for(cfg.outputs):
        df = _attach_key(df, stats, name, f"__{name}")
    df = df.withColumns({o: ENCODINGS[o][1](cfg) for o in cfg.outputs})
    return df.drop(*[c for c in df.columns if c.startswith("__") and c not in apply.columns])


def strict_frames(rows: DataFrame, stats: FittedStats, cfg: Encodings, fold_col: str, n_splits: int) -> DataFrame:
    """Every row once for each outer fold (`outer`, and `role` fit or valid), encoded
    strictly: the training and validation frames of all folds as one table, from one fit
    of the statistics and without a loop over folds."""
    each = rows.withColumn("outer", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    each = each.withColumn("role", F.when(F.col(fold_col) == F.col("outer"), "valid").otherwise("fit"))
    return apply_strict(each, stats, cfg, F.col("outer"), F.col(fold_col))


def _check_smoothing(smoothing: float) -> None:
    if smoothing < 0:
        raise ValueError(f"smoothing is {smoothing}; it must be 0 or more")


# ----------------------------------------------------------- simple forms
def smoothed_target_encoding(fit: DataFrame, apply: DataFrame, key: Column, target: Column, smoothing: float,
                             out_col: str) -> DataFrame:
    """One key, full fit -> apply."""
    _check_smoothing(smoothing)
    stats = fit_stats(fit, target, {"k": key})
    df = _with_fold(apply, stats, F.lit(NO_FOLD))
    df = _attach_key(df, stats, "k", "__k")
    return df.withColumn(out_col, _smoothed("__k", smoothing)).drop(
        "__afold", "__gmean", "__k_s", "__k_n", "__k_r")


def smoothed_target_encoding_with_backoff(fit: DataFrame, apply: DataFrame, key: Column, target: Column,
                                          smoothing: float, min_count: int, fallback: Column,
                                          out_col: str) -> DataFrame:
    """Own encoding when the key has >= min_count fit targets, else the
    per-row `fallback` (itself filled with the global mean)."""
    if min_count < 1:
        raise ValueError(f"min_count is {min_count}; a key needs 1 or more rows")
    stats = fit_stats(fit, target, {"k": key})
    df = _with_fold(apply, stats, F.lit(NO_FOLD)).withColumn("__fb", fallback)
    df = _attach_key(df, stats, "k", "__k")
    n = F.coalesce(F.col("__k_n"), F.lit(0))
    fb = F.coalesce(F.col("__fb"), F.col("__gmean"))
    enc = F.when(n >= min_count, _smoothed("__k", smoothing)).otherwise(fb)
    return df.withColumn(out_col, F.coalesce(enc, fb)).drop("__afold", "__gmean", "__fb", "__k_s", "__k_n", "__k_r")


# ------------------------------------------------------ price proxies T4-T6
@dataclass
class PriceProxyEncoder:
    """T5 fitted state: full-train statistics for the proxy columns."""

    columns: tuple[str, ...]
    feature_suffix: str
    smoothing: float
    target_space: str
    stats: FittedStats

    def save(self, path: str) -> None:
        self.stats.save(f"{path}/stats")
        row = (list(self.columns), self.feature_suffix, float(self.smoothing), self.target_space)
        (self.stats.keys.sparkSession.createDataFrame([row], "columns array<string>, suffix string, smoothing double, space string")
         .write.mode("overwrite").parquet(f"{path}/numbers"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "PriceProxyEncoder":
        r = spark.read.parquet(f"{path}/numbers").first()
        stats = FittedStats.load(spark, f"{path}/stats", {c: norm_key(c) for c in r["columns"]})
        return cls(tuple(r["columns"]), r["suffix"], r["smoothing"], r["space"], stats)

    def transform(self, df: DataFrame) -> DataFrame:
        return _proxy_apply(df, self.stats, self.columns, self.feature_suffix, self.smoothing, F.lit(NO_FOLD))


def _proxy_apply(df: DataFrame, stats: FittedStats, columns, suffix: str, smoothing: float,
                 apply_fold: Column) -> DataFrame:
    out = _with_fold(df, stats, apply_fold)
    for col in columns:
        out = _attach_key(out, stats, col, f"__p_{col}")
        out = out.withColumn(f"{col}{suffix}", _smoothed(f"__p_{col}", smoothing)).drop(
            f"__p_{col}_s", f"__p_{col}_n", f"__p_{col}_r")
    return out.drop("__afold", "__gmean")


def _proxy_target(df: DataFrame, target_col: str, space) -> Column:
    return transform_target_for_encoding(F.col(target_col), space)


def fit_price_proxy_encoder(train: DataFrame, target_col: str = C.TARGET_COL, columns=("brand", "model"),
                            smoothing: float = 20.0, feature_suffix: str = "_price_mean",
                            target_space="raw") -> PriceProxyEncoder:
    """T5 fit: full-train mappings for holdout/test rows."""
    _check_columns(train, columns)
    _check_smoothing(smoothing)
    stats = fit_stats(train, _proxy_target(train, target_col, target_space), {c: norm_key(c) for c in columns})
    return PriceProxyEncoder(tuple(columns), feature_suffix, smoothing, scale(target_space).label, stats)


def build_oof_price_proxy_features(train: DataFrame, fold_col: str, n_splits: int, target_col: str = C.TARGET_COL,
                                   columns=("brand", "model"), smoothing: float = 20.0,
                                   feature_suffix: str = "_price_mean", target_space="raw") -> DataFrame:
    """T4: strict out-of-fold encodings for train rows (each row is encoded
    from the other folds only; the fold's own global mean is the fallback)."""
    _check_columns(train, columns)
    if n_splits < 2:
        raise ValueError(f"{n_splits} folds: rows are encoded from the other ones, so 2 or more are needed")
    _check_smoothing(smoothing)
    stats = fit_stats(train, _proxy_target(train, target_col, target_space),
                      {c: norm_key(c) for c in columns}, fold_col)
    return _proxy_apply(train, stats, columns, feature_suffix, smoothing, F.col(fold_col))


def build_oof_and_apply_price_proxy_features(train: DataFrame, apply: DataFrame, fold_col: str, n_splits: int,
                                             target_col: str = C.TARGET_COL, columns=("brand", "model"),
                                             smoothing: float = 20.0, feature_suffix: str = "_price_mean",
                                             target_space="raw") -> tuple[DataFrame, DataFrame, PriceProxyEncoder]:
    """T4 for train rows + T5 for apply rows. One aggregation serves both:
    apply fold 0 is the full-train statistic."""
    _check_columns(train, columns)
    stats = fit_stats(train, _proxy_target(train, target_col, target_space),
                      {c: norm_key(c) for c in columns}, fold_col)
    enc = PriceProxyEncoder(tuple(columns), feature_suffix, smoothing, scale(target_space).label, stats)
    train_out = _proxy_apply(train, stats, columns, feature_suffix, smoothing, F.col(fold_col))
    return train_out, enc.transform(apply), enc


def _check_columns(df: DataFrame, columns) -> None:
    if not columns:
        raise ValueError("no column to encode is named")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"the rows have no column {missing} to encode")
