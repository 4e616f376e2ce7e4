"""Registered queries of the training-data operators, over whole driver tables."""

from __future__ import annotations

from lathework.llm.queries import FAMILIES

QUERIES = {name: fn for family in FAMILIES for name, fn in family.QUERIES.items()}
ORACLE = {name: sql for family in FAMILIES for name, sql in family.ORACLE.items()}
