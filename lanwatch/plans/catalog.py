"""Registered queries: one Spark callable and (where SQL can say it) one oracle.

Every query reads the driver's tables (through the packet view of
``sources.fixture``) so that its work grows with them.  Oracle SQL is written
independently in DuckDB's dialect over the same view; computed columns carry
the same aliases on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None, extra_ctes: str = ""):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = fixture.oracle_view(oracle, extra_ctes)
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# Sub-modules register themselves on import.
from . import q_features, q_dataset, q_rules, q_risk, q_ml, q_io, q_stream  # noqa: E402,F401
