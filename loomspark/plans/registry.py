"""All queries of the core, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import curation_plans, graph_plans, measure_plans, relation_plans, relational_plans, selection_plans, stream_plans, time_plans, verdict_plans, view_plans

_MODULES = (view_plans, verdict_plans, graph_plans, time_plans, curation_plans, measure_plans, relational_plans, selection_plans, stream_plans, relation_plans)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in _MODULES for name, run in module.P.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.P.sql.items()}
