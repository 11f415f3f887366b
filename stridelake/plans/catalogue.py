"""The registered queries of the core library, by group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stridelake.plans import q_aggs, q_clean, q_joins, q_scoring, q_shape, q_sources, q_streaming, q_wager, q_windows

GROUPS: list = [q_shape, q_joins, q_windows, q_aggs, q_clean, q_scoring, q_wager, q_sources, q_streaming]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent form over the runners of every race."""
    return queries()["w3_prior_n"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to a callable of (spark, sf_dir)."""
    return {name: build for group in GROUPS for name, (build, _) in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Name to reference SQL, for the queries that SQL can express."""
    return {name: sql for group in GROUPS for name, (_, sql) in group.QUERIES.items() if sql}
