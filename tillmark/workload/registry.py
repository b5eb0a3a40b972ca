"""Registry of the workload queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.session import configure_stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Result columns in types every engine spells alike: bigint, double, string, boolean."""
    columns = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(f.dataType, T.IntegralType):
            col = col.cast("bigint")
        columns.append(col.alias(f.name))
    return df.select(*columns)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(configure_stored(spark), sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register
