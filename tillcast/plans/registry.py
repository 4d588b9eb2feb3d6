"""Registry of queries: a name, the Spark plan over the retail inputs, and where one exists
the independent SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillcast.plans.reference_sql import COMMON
from tillcast.sources.retail import RetailInputs

# Steps that a check reads several times and should work out once.
ONCE = {"dense_sf", "candidates", "shipment_links", "clean_lines", "dense_days", "dense_demand", "dense_promo", "dense_weeks"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _used(text: str) -> list[str]:
    words = set(re.findall(r"[a-z_][a-z0-9_]*", text))
    return [name for name in COMMON if name in words]


def with_common(body: str) -> str:
    """Prefix the shared inputs (and what they build on) that the statement names."""
    need: set[str] = set()
    todo = [body]
    while todo:
        for name in _used(todo.pop()):
            if name not in need:
                need.add(name)
                todo.append(COMMON[name])
    ctes = [f"{name} AS {'MATERIALIZED ' * (name in ONCE)}(\n{COMMON[name].strip()}\n)" for name in COMMON if name in need]
    body = body.strip()
    if not ctes:
        return body
    if body[:5].lower() == "with ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[RetailInputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(RetailInputs(spark, folder))
        if sql is not None:
            SQL[name] = with_common(sql)
        return fn
    return register
