"""What a raw file's path says about it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def batch_ts(path: Column, table: str) -> Column:
    """The time in ``{table}_{yyyymmdd_HHMMSS}.csv``; NULL when the name has another form.

    The named entry may be a file or, as Spark writes them, a directory of part files.
    """
    stamp = F.regexp_extract(path, rf"(?:^|/){table}_(\d{{8}}_\d{{6}})\.csv(?:/|$)", 1)
    iso = F.regexp_replace(stamp, r"^(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})$", r"$1-$2-$3 $4:$5:$6")
    return F.when(stamp != "", iso.try_cast("timestamp_ntz"))
