"""Reading the corpus tables, naming rows, and small joins back to documents."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, new_path

__all__ = ["arrow_schema", "drop_listed", "materialise", "numbered", "packed", "read"]

MAX_BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Like `materialise`, for wide columns: compressed more closely, the closer the higher the level."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """A number for each row, so that NULL and repeated ids stay apart. Store it before it is used twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def arrow_schema(ddl: str) -> pa.Schema:
    """The few flat types the Python steps return."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
        "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (part.strip().split(" ", 1) for part in ddl.split(","))])


def drop_listed(docs: DataFrame, listed: DataFrame, on: dict) -> DataFrame:
    """Rows of `docs` of which no row of the stored table `listed` has the same values.

    `on` maps columns of `listed` to expressions over `docs`; NULL equals NULL. The list is counted:
    a short one is broadcast, so that texts stay where they are, a long one is joined by a shuffle.
    """
    right = listed.select([F.col(c).alias(f"_listed_{i}") for i, c in enumerate(on)]).distinct()
    if listed.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        right = F.broadcast(right)
    same = F.lit(True)
    for i, expression in enumerate(on.values()):
        same = same & expression.eqNullSafe(F.col(f"_listed_{i}"))
    return docs.join(right, same, "left_anti")
