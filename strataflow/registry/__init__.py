"""Registered queries and their SQL counterparts, by family."""

from strataflow.registry import (
    aggregates,
    flows,
    governance,
    history,
    quality,
    sinks,
    sources,
    transforms,
)

FAMILIES = (quality, transforms, aggregates, history, sources, governance, sinks, flows)
QUERIES = {name: query for family in FAMILIES for name, query in family.QUERIES.items()}
SQL = {name: sql for family in FAMILIES for name, sql in family.SQL.items()}
