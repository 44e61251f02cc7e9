"""Reading stored pages, seed lists and the tables of earlier stages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PAGES

_NESTED = (T.MapType, T.ArrayType, T.StructType)


def page_source(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages `(page_id, url, html)`; a folder or a file."""
    return spark.read.schema(PAGES).parquet(path)


def seed_scan(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Names to look up. A file without a `name` column raises `AnalysisException`."""
    reader = spark.read.option("header", True) if format == "csv" else spark.read
    return reader.format(format).load(path).select(F.col("name").cast("string"))


def stage_scan(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """Table of an earlier stage, with its fixed schema. CSV files hold nested columns as JSON."""
    if format != "csv":
        return spark.read.schema(schema).format(format).load(path)
    flat = T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, _NESTED) else f.dataType)
            for f in schema
        ]
    )
    rows = (
        spark.read.schema(flat)
        .options(header=True, multiLine=True, quote='"', escape='"', nullValue="\\N", emptyValue="")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return rows.select(
        [
            F.from_json(f.name, f.dataType).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)
            for f in schema
        ]
    )


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows with its schema on the first run."""
    try:
        return stage_scan(spark, path, schema)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
