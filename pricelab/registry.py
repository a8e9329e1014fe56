"""Query registry: one Spark query per operator id of the blueprint, and its SQL oracle.

Each query takes ``(spark, sf_dir)``, reads the provided tables (or inputs Spark derives from them)
and returns a DataFrame. Doubles from aggregates are rounded to 6 decimals on both sides so that a
different summation order cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


ROUND_LIMIT = 1e12  # beyond this magnitude values are compared unrounded


def round_col(c, digits: int = 6):
    """Round half up as plain double arithmetic, ``floor(x * 10^d + 0.5) / 10^d``, spelled the same way
    in the SQL oracle (``rnd_sql``) so both engines make the same decision at a near-tie (the built-in
    ``round`` functions of the two engines break near-ties differently)."""
    scale = 10 ** digits
    return F.when(F.abs(c) < ROUND_LIMIT, F.floor(c * scale + 0.5) / scale).otherwise(c)


def rnd_sql(expr: str, digits: int = 6) -> str:
    scale = f"CAST(1e{digits} AS DOUBLE)"
    return f"(CASE WHEN abs({expr}) < {ROUND_LIMIT!r} THEN floor(({expr}) * {scale} + 0.5) / {scale} ELSE ({expr}) END)"


def round_py(x: float, digits: int = 6) -> float:
    """The same rule for numbers on the driver."""
    import math

    return math.floor(x * 10 ** digits + 0.5) / 10 ** digits if abs(x) < ROUND_LIMIT else x


def rounded(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every floating column (aggregates) to ``digits`` decimals."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in skip:
            cols.append(round_col(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def r6(expr: str) -> str:
    return rnd_sql(expr, 6)


# importing the query modules fills the registry
from .queries import q_features, q_ingest, q_metrics, q_misc, q_models, q_predictions, q_quality, q_stream, q_tfidf, q_windows  # noqa: E402,F401
