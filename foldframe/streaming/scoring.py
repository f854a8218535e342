"""Scoring listings arriving as a stream.

The reference is batch-only; what carries over to a stream unchanged are
the row-local feature steps and the frozen (fitted) encoder mappings, which
are joined to each micro-batch as static broadcast tables (stream-static
left joins). Statistics that need the whole table (counts, group stats,
folds) are not computed on the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import clean, encode, features


def score_stream(stream: DataFrame, encoder: encode.PriceProxyEncoder) -> DataFrame:
    """Row-local features (F1, D2, D4, F3) + category keys + frozen price
    proxies on a streaming (or batch) DataFrame."""
    out = features.add_date_features(features.normalize_numeric_columns(stream))
    out = features.add_power_age_features(features.add_age_detail_features(out))
    out = clean.normalize_categorical_columns(out)
    return encoder.transform(out)


def start_scoring(spark: SparkSession, source_dir: str, schema: StructType, encoder: encode.PriceProxyEncoder,
                  sink_dir: str, checkpoint_dir: str, available_now: bool = True) -> StreamingQuery:
    """Parquet files in `source_dir` -> scored rows appended to `sink_dir`
    (exactly-once file sink; progress kept in `checkpoint_dir`, which on a
    cluster must be on shared storage)."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = (score_stream(stream, encoder).writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
