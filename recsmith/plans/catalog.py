"""Registered queries: name -> Spark plan over the test tables, and its DuckDB oracle.

Every query reads the given tables (through the fixture mapping) and runs over
all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recsmith.operators import metrics
from recsmith.plans import local_chain
from recsmith.plans import oracle_sql as osql

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return deco


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # Importing the modules registers their queries.
    from recsmith.plans import (queries_batch, queries_models, queries_monitoring, queries_streams,  # noqa: F401
                                queries_validation)


# ---- the local chain -------------------------------------------------------

@register("top_k_unseen", osql.flagship_sql(10))
def q_top_k_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 flagship: top-10 unseen items for every user with test rows."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    return local_chain.recommendations(c, 10)


@register("temporal_split_test", osql.split_test_sql())
def q_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test rows of the time split (last 20 %, at least one)."""
    return local_chain.prepare_fixture(spark, sf_dir).test


@register("base_scores", osql.base_scores_sql())
def q_base_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 + A9: base score of every catalogue item from the train rows."""
    return local_chain.prepare_fixture(spark, sf_dir).scores


@register("evaluation_suite", osql.evaluation_sql(20))
def q_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1-E9 at K = 5, 10, 20 over top-20 lists for every user with test rows."""
    c = local_chain.prepare_fixture(spark, sf_dir)
    recs = local_chain.recommendations(c, 20, keep=True)
    return metrics.evaluation_suite(recs, c.test, c.items)
