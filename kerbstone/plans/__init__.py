"""Registered queries and their SQL twins, by area."""

from __future__ import annotations

from . import conditions, labels, layouts, lines, orders, places

_AREAS = (conditions, labels, layouts, lines, orders, places)


def queries():
    return {k: f for area in _AREAS for k, f in area.QUERIES.items()}


def oracle_sql():
    return {k: sql for area in _AREAS for k, sql in area.SQL.items()}
