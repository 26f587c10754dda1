"""The queries of this subpackage and the SQL that some must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


#: Rows that go to a Python worker at a time: texts are long, and both sides hold a batch whole.
BATCH_ROWS = 1000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver does, if they see that folder, and
    send them rows in batches that suit long texts.

    Where they don't see it, the package is shipped like any other (``--py-files``).
    """
    spark.conf.set(_ROWS, str(min(BATCH_ROWS, int(spark.conf.get(_ROWS)))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Decorator: register a query under a name, with its SQL if it has one."""

    def register(run: Query) -> Query:
        @wraps(run)
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            importable(spark)
            return run(spark, folder)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = sql
        return prepared

    return register
