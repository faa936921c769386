"""All registered queries: batch (``queries``) and streaming (``stream_queries``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from salespark.plans import queries as B
    from salespark.plans import stream_queries as S
    return {**B.query_map(), **S.query_map()}


def all_oracles() -> dict[str, str]:
    from salespark.plans import queries as B
    from salespark.plans import stream_queries as S
    return {**B.oracle_map(), **S.oracle_map()}
