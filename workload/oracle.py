"""Puts together the CTEs a query needs into one DuckDB statement."""

from __future__ import annotations

import re

from workload.oracle_feeds import FEEDS
from workload.oracle_jobs import JOBS

CTES = FEEDS | JOBS


def _needs(sql: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b(FROM|JOIN)\s+{n}\b", sql)]


def _ordered(name: str, seen: list[str]) -> list[str]:
    for n in _needs(CTES[name]):
        if n != name and n not in seen:
            _ordered(n, seen)
    if name not in seen:
        seen.append(name)
    return seen


def statement(select: str) -> str:
    """``select`` with the CTEs it refers to, directly and indirectly, in front."""
    seen: list[str] = []
    for n in _needs(select):
        _ordered(n, seen)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in seen)
    return f"WITH {ctes}\n{select}" if ctes else select
