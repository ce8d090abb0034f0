"""All registered queries of the core and the SQL that checks them."""

from __future__ import annotations

from larkspur.plans import forum, forum_sql, general, layers

MODULES = (general, forum, layers)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict:
    return general.SQL | forum_sql.SQL | layers.SQL
