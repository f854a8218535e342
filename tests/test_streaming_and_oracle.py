"""Streaming scorer equals the batch transform; a sample of registry
queries equals its DuckDB oracle on the smallest driver tables."""

import os
import tempfile

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from foldframe.operators import encode
from foldframe.sources import fixture
from foldframe.streaming.scoring import score_stream, start_scoring

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "orders", "lineitem"]


def test_stream_matches_batch(spark):
    train, test = fixture.split_train_test(fixture.listings(spark, SF))
    enc = encode.fit_price_proxy_encoder(clean_keys(train), columns=("brand", "model"))
    src = tempfile.mkdtemp(prefix="ff-src-")
    enc.save(src + "/encoder")  # the stream starts from the saved encoder
    enc = encode.PriceProxyEncoder.load(spark, src + "/encoder")
    test.write.mode("overwrite").parquet(src + "/in")
    sink, ck = tempfile.mkdtemp(prefix="ff-sink-"), tempfile.mkdtemp(prefix="ff-ck-")
    q = start_scoring(spark, src + "/in", test.schema, enc, sink + "/out", ck)
    q.awaitTermination(300)
    streamed = {r["SaleID"]: r["brand_price_mean"] for r in spark.read.parquet(sink + "/out").collect()}
    batch = {r["SaleID"]: r["brand_price_mean"] for r in score_stream(test, enc).collect()}
    assert streamed.keys() == batch.keys() and len(batch) > 0
    assert all(streamed[k] == pytest.approx(batch[k]) for k in batch)


def clean_keys(df):
    from foldframe.operators import clean
    return clean.normalize_categorical_columns(df)


@pytest.mark.parametrize("name", ["date_parts", "count_encoding", "model_age_stats", "stratified_assign",
                                  "te_all", "blend_grid", "fold_metrics", "mean_cv_oof", "make_data"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    cols = sorted(got.columns)

    def cell(v):
        if v is None or (not isinstance(v, str) and pd.isna(v)):
            return None
        if isinstance(v, (bool, np.bool_)):
            return bool(v)
        if isinstance(v, (int, float, np.integer, np.floating)):
            return round(float(v), 6)
        return v

    def canon(df):
        return sorted((tuple(cell(v) for v in row) for row in df[cols].itertuples(index=False)), key=repr)

    assert canon(got) == canon(exp)
