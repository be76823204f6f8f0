"""Every registered query with its SQL."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries as _queries
from . import raw as _raw
from .sql import SQL

FLAGSHIP = "company_rollup"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The public functions of the query modules, in their order."""
    return {
        name: f
        for module in (_queries, _raw)
        for name, f in vars(module).items()
        if inspect.isfunction(f) and f.__module__ == module.__name__ and not name.startswith("_")
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
