"""Registered queries: every operator over the given tables, with the SQL that must agree."""

from millrace.queries import experiments, features, files, registry, scalars, statistics, streams

MODULES = (features, statistics, experiments, registry, files, scalars, streams)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
