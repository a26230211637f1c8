"""Registered queries over the given tables, each with the SQL that gives the same rows."""

from logweir.workload import (
    detect,
    dimensions,
    incremental,
    lines,
    loads,
    mapping,
    reports,
    stores,
    upkeep,
)

_MODULES = [lines, mapping, dimensions, incremental, detect, loads, stores, upkeep, reports]


def all_queries():
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def all_sql():
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
