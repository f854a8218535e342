"""Sources and sinks (S1-S12): raw space-separated listings, csv, parquet,
OOF / submission tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..operators import validate as V
from ..session import scratch_path  # noqa: F401

RAW_SEPARATOR = " "

# listing schema of the raw files (train has price, test does not)
LISTING_SCHEMA = T.StructType(
    [T.StructField("SaleID", T.LongType()), T.StructField("name", T.LongType()),
     T.StructField("regDate", T.StringType()), T.StructField("model", T.DoubleType()),
     T.StructField("brand", T.LongType()), T.StructField("bodyType", T.DoubleType()),
     T.StructField("fuelType", T.DoubleType()), T.StructField("gearbox", T.DoubleType()),
     T.StructField("power", T.DoubleType()), T.StructField("kilometer", T.DoubleType()),
     T.StructField("notRepairedDamage", T.StringType()), T.StructField("regionCode", T.LongType()),
     T.StructField("seller", T.IntegerType()), T.StructField("offerType", T.IntegerType()),
     T.StructField("creatDate", T.StringType()), T.StructField("price", T.DoubleType())]
    + [T.StructField(f"v_{i}", T.DoubleType()) for i in range(15)])


MALFORMED = "_malformed"
TYPES = {f.name: f.dataType for f in LISTING_SCHEMA}


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names as the file's first line has them."""
    return spark.read.option("sep", RAW_SEPARATOR).option("header", True).csv(path).columns


def read_raw_listing(spark: SparkSession, path: str, dataset_name: str = "data", validate: bool = False,
                     require_target: bool | None = None, types: dict[str, T.DataType] | None = None,
                     keep_malformed: bool = False) -> DataFrame:
    """Exactly one space between fields, so consecutive separators give NULL fields.

    Columns are taken by the names in the header, whatever their order, and get the
    types of `types` (default: the listing columns; `v_*` are doubles; others stay
    text). Cells that their type cannot hold become NULL. With `validate`, required
    columns, the target and value ranges are checked (V3) and rows with more or fewer
    fields than the header are an error; `keep_malformed` marks them in a column instead."""
    names = header_of(spark, path)
    file_schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
    rows = (spark.read.option("sep", RAW_SEPARATOR).option("header", True).option("enforceSchema", False)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("columnNameOfCorruptRecord", MALFORMED).schema(file_schema).csv(path))
    known = types or TYPES
    kind = lambda n: known.get(n, T.DoubleType() if n.startswith("v_") else T.StringType())
    df = rows.select(*[F.col(f"`{n}`").try_cast(kind(n)).alias(n) for n in names], *([MALFORMED] if keep_malformed else []))
    if validate:
        V.validate_raw_dataframe(df, dataset_name, require_target)
        # the checksum reads every column: a scan of some of them does not count the fields
        every = F.bit_xor(F.xxhash64(*[F.col(f"`{n}`") for n in names]))
        bad = rows.agg(every.alias("all"), F.count(MALFORMED).alias("bad")).first()["bad"]
        if bad:
            raise ValueError(f"{dataset_name} has {bad} rows whose number of fields is not that of its header")
    return df


def load_train_data(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    """Train scan; the target is required."""
    df = read_raw_listing(spark, path, "train", validate, True)
    if C.TARGET_COL not in df.columns:
        raise ValueError(f"{path} has no column {C.TARGET_COL}")
    return df


def load_test_data(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    return read_raw_listing(spark, path, "test", validate, False)


def load_data(spark: SparkSession, train_path: str, test_path: str) -> tuple[DataFrame, DataFrame]:
    """S3: the trainer's own scan, checked for value ranges only (V4)."""
    train, test = (read_raw_listing(spark, p) for p in (train_path, test_path))
    return V.validate_ranges_only(train, "train"), V.validate_ranges_only(test, "test")


def save_raw_listing(df: DataFrame, path: str) -> None:
    """S11 sink: single-space separated with header (NULL -> empty field)."""
    (df.write.mode("overwrite").option("sep", RAW_SEPARATOR).option("header", True)
     .option("nullValue", "").option("emptyValue", "").csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S4 source: comma-separated with header; without a schema columns are inferred, which
    reads the file once more."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def _typed_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The columns of a comma-separated file in the types given, read once."""
    df = spark.read.option("header", True).csv(path)
    if lacking := sorted(set(columns) - set(df.columns)):
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])


def save_csv(df: DataFrame, path: str) -> None:
    """S4 sink: comma-separated with header, no index."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_oof(spark: SparkSession, name: str, path: str) -> DataFrame:
    """(SaleID, price, oof_pred -> name); raises when a column is missing."""
    df = _typed_csv(spark, path, {C.ID_COL: "long", C.TARGET_COL: "double", "oof_pred": "double"})
    return df.withColumnRenamed("oof_pred", name)


def load_submission(spark: SparkSession, name: str, path: str) -> DataFrame:
    """(SaleID, price -> name)."""
    return _typed_csv(spark, path, {C.ID_COL: "long", C.TARGET_COL: "double"}).withColumnRenamed(C.TARGET_COL, name)


def write_standard_outputs(out_dir: str, oof: DataFrame | None = None, submission: DataFrame | None = None,
                           valid_predictions: DataFrame | None = None) -> None:
    """OOF table, submission (SaleID, price) and validation
    predictions (SaleID, price, prediction, abs_error)."""
    if oof is not None:
        save_csv(oof, f"{out_dir}/oof_predictions")
    if submission is not None:
        save_csv(submission.select(C.ID_COL, C.TARGET_COL), f"{out_dir}/submission")
    if valid_predictions is not None:
        save_csv(valid_predictions.select(C.ID_COL, C.TARGET_COL, "prediction", "abs_error"),
                 f"{out_dir}/valid_predictions")
