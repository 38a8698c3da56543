"""Named queries over the test tables, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from telemetry_ops.plans import alerting, diagnosis, evaluation, feature, learning, profiling, quality, source, stream

_MODULES = (source, quality, profiling, feature, learning, evaluation, diagnosis, alerting, stream)


def all_queries() -> dict:
    return {name: run for module in _MODULES for name, (run, _) in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql}
