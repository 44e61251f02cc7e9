"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession


def build_session(app: str = "citeweave", master: str | None = None, **settings) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # No Python call site per column: plans here have thousands of small expressions.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, from `spark.checkpoint.dir`.

    Only a session whose tasks run in this process may fall back to a temporary folder of
    this machine; the setting itself cannot be changed in a running session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="citeweave-")
    return _FALLBACK[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/citeweave/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Used where a result feeds several branches: the work above is done once, lineage is
    cut, and a lost executor loses nothing.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PAGE_ROWS = 5_000  # rows that become pages, of one task


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Use every core on a small sample table with fewer splits than cores; not for pages in storage.

    `rows` bounds, about, what one task gets: for rows that are small in storage and much larger once worked on.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    if rows:
        tasks = max(tasks, -(-df.count() // rows))
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


class per_session:
    """Columns built once per application instead of once per query; `columns(df)` returns them.

    A stream hands its batches over in sessions of their own, which share the application's columns.
    """

    def __init__(self, build: Callable[[], list[Column]]):
        self.build, self.built = build, WeakKeyDictionary()

    def __call__(self, df: DataFrame) -> list[Column]:
        context = df.sparkSession.sparkContext
        if context not in self.built:
            self.built[context] = self.build()
        return self.built[context]
