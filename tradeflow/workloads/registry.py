"""All workloads and their oracle SQL, by name."""

from __future__ import annotations

from . import columns, cubes, increment, jobs, matrix, observe, plans, recovery, stages, star

_MODULES = [star, columns, cubes, matrix, plans, increment, stages, recovery, jobs, observe]


def queries() -> dict:
    out: dict = {}
    for module in _MODULES:
        out.update(module.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in _MODULES:
        out.update(module.SQL)
    return out
