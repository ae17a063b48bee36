"""Registry of named query plans and their DuckDB oracle SQL.

Each plan is ``(spark, sf_dir) -> DataFrame`` over the driver's whole
tables. The oracle text is the same computation in DuckDB SQL, with the
same output column names; plans without an oracle are checked by row count
and by unit tests against brute force on small fixtures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import to_output

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
IDS: dict[str, str] = {}


def query(name: str, ids: str, sql: str | None = None, dates: tuple[str, ...] = ("date",)):
    """Register a plan under ``name`` (operator ids in ``ids``).

    Calendar-date outputs are emitted as midnight TIMESTAMP_NTZ on both
    sides (``dates`` names them for the oracle), so every engine and client
    library renders them the same way.
    """

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_output(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.__wrapped__ = fn
        QUERIES[name] = run
        IDS[name] = ids
        if sql is not None:
            ORACLES[name] = _wrap_dates(sql, dates)
        return run

    return deco


def _wrap_dates(sql: str, dates: tuple[str, ...]) -> str:
    if not dates:
        return sql
    repl = ", ".join(f"CAST({d} AS TIMESTAMP) AS {d}" for d in dates)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) q"


def load_all() -> None:
    """Import every plan module so the registry is complete."""
    from . import q_daily, q_dashboard, q_extra, q_features, q_forecast, q_ingest, q_quality, q_station, q_stream  # noqa: F401
