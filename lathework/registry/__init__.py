"""Registered queries over the driver tables, each beside the SQL that checks it."""

from __future__ import annotations

from lathework.registry import clusters, files, graphs, logs, presence, streams, texts

FAMILIES = [logs, texts, files, graphs, presence, clusters, streams]
QUERIES = {name: fn for family in FAMILIES for name, fn in family.QUERIES.items()}
ORACLE = {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
