"""Values worked out once per row, and maps built inside a row from two lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def worked_out(*columns: Column) -> Column:
    """The columns as those of a generator: each is worked out once per row, whatever is done with it later.

    A filter is pushed through a projection and repeats what it names, also the one Spark adds below an `explode`; it is not
    pushed through a generator. All the columns are worked out, so leave out those that nobody asks for.
    """
    return F.inline(F.array(F.struct(*columns)))


def zip_short(keys: Column, values: Column) -> Column:
    """Pairs `(k, v)` by position, as many as the shorter list has."""
    n = F.least(F.size(keys), F.size(values))
    return F.arrays_zip(
        F.slice(keys, 1, n).alias("k"), F.slice(values, 1, n).alias("v")
    )


def last_wins(pairs: Column) -> Column:
    """Map of `(k, v)` structs, sorted by key; of a repeated key the last value counts.

    Independent of the session's duplicate-key policy, and n log n however long the page's list is.
    """
    # The last pair of each key comes first among its equals.
    ordered = F.array_sort(
        F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), (-i).alias("n"), p["v"].alias("v")))
    )
    lasts = let(
        ordered, lambda o: F.filter(o, lambda p, i: (i == 0) | (p["k"] != F.get(o, i - 1)["k"]))
    )
    return F.map_from_entries(F.transform(lasts, lambda p: F.struct(p["k"], p["v"])))
