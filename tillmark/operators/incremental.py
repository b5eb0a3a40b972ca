"""High-water marks: read only what arrived since the last run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the mark of a table that was never processed.
EPOCH = dt.datetime(1970, 1, 1)


def rows_since(df: DataFrame, mark: dt.datetime, column: str = "_loaded_at") -> DataFrame:
    """Rows strictly newer than the mark; the comparison is pushed into the Parquet scan."""
    return df.where(F.col(column) > F.lit(mark).cast("timestamp_ntz"))


def next_mark(column: str = "_loaded_at", previous: dt.datetime = EPOCH) -> Column:
    """Aggregate: the newest value read, or the previous mark when nothing was read."""
    return F.coalesce(F.max(column), F.lit(previous).cast("timestamp_ntz"))
