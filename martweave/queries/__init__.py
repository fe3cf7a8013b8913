"""Registered queries: one per operator, over whole tables, most with the SQL they must equal."""

from __future__ import annotations

from martweave.queries import backlog, checks, configuration, files, loading, mart, ordering, streams

_MODULES = (loading, mart, checks, configuration, ordering, files, backlog, streams)

QUERIES = {name: run for module in _MODULES for name, (run, _) in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql is not None}
