"""Every operator and job as a query over the given tables, with its ANSI SQL counterpart.

A query is a function `(spark, sf_dir) -> DataFrame`; the SQL runs on the same tables.
"""

from . import citing, details, matching, nodes, people, records, tables

_MODULES = (tables, nodes, people, details, matching, citing, records)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
