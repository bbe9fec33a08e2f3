"""Where queries and the SQL that must give the same rows are kept together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sql import with_tables

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, tables: str = "", sql: str | None = None):
    """Register a query; ``sql`` selects from the stand-ins named in ``tables``."""
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_tables(tables, sql) if tables else sql
        return fn
    return keep


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def rnd(*columns: str, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
