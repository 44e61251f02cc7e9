"""Rows not yet done: the state between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .hot_keys import HOT_ROWS, hot_join


def done_keys(done: DataFrame, key: str) -> DataFrame:
    return done.select(F.col(key).alias("_done")).distinct()


def pending(rows: DataFrame, key: str, done: DataFrame | None, done_key: str,
            hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose key is not among the done ones. A NULL key is done once a NULL is done.

    Do this before any page is parsed: Catalyst moves no filter through the Python step.
    """
    if done is None:
        return rows
    keys = done.select(F.col(done_key).alias("_done"))
    return hot_join(rows, key, keys, "_done", "left_anti", null_safe=True, distinct=True, hot_rows=hot_rows)


def _is_stored(rows: DataFrame) -> bool:
    """Whether rows are columns of a stored table, so that reading them again is all that they cost."""
    plan = rows._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in ("Project", "Filter") and plan.children().size() == 1:
        plan = plan.children().head()
    return plan.nodeName().startswith("LogicalRelation") or "Relation" in plan.nodeName()


def pending_once(rows: DataFrame, key: str, done: DataFrame | None, done_key: str,
                 hot_rows: int = HOT_ROWS, **_lookup_options) -> DataFrame:
    """`pending`, worked out once: a job measures its rows, asks for their pages and joins them.

    Columns of a stored table are not written again. The jobs pass on their options; those of the page lookup do not matter here.
    """
    if done is None and _is_stored(rows):
        return rows
    return materialise(pending(rows, key, done, done_key, hot_rows), "pending")
