"""Registered queries and, where it can be stated, the same result in SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.plans.shapes_sql import STEPS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def with_steps(body: str) -> str:
    """Prefix a SELECT with the named steps it uses, directly or through other steps."""
    used: list[str] = []

    def visit(text: str) -> None:
        for name in STEPS:
            if name not in used and re.search(rf"\b{name}\b", text):
                visit(STEPS[name])
                if name not in used:
                    used.append(name)

    visit(body)
    if not used:
        return body
    steps = ",\n".join(f"{name} AS ({STEPS[name]})" for name in used)
    if body.lower().startswith("with "):
        return f"WITH {steps},\n{body[5:]}"
    return f"WITH {steps}\n{body}"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with its SQL over the given tables."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_steps(sql.strip())
        return run

    return add
