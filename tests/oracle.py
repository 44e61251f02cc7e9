"""Compare a query with its SQL counterpart, run by DuckDB on the same tables.

`python -m tests.oracle [sf_dir] [name ...]` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

KINDS = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE"}


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _ordered(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(df, sql, con) -> list[str]:
    """What differs between the two results: columns, types, rows."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    found = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if kinds != found:
        return [f"columns {found} instead of {kinds}"]
    want = _ordered(expected.fetchall(), names)
    have = _ordered([tuple(r) for r in df.collect()], df.columns)
    if want == have:
        return []
    from collections import Counter

    missing, extra = Counter(want) - Counter(have), Counter(have) - Counter(want)
    return [
        f"{len(have)} rows instead of {len(want)}",
        f"missing {list(missing.items())[:2]}",
        f"extra {list(extra.items())[:2]}",
    ]


def main(argv):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries

    from .session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.001"
    spark, con, failed = local_session(), duck(sf_dir), 0
    for name, query in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            problems = differences(query(spark, sf_dir), oracle_sql()[name], con)
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
