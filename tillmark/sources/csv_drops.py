"""Raw CSV drops: which files there are, how each is laid out, and their rows bound by column name."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmark.functions.filenames import batch_ts
from tillmark.session import fresh_dir
from tillmark.sources.folders import any_match
from tillmark.specs import TableSpec


def drop_pattern(raw_dir: str, table: str) -> str:
    """``{raw}/{table}/{table}_*.csv``; a match is one file, or a folder of part files."""
    return f"{raw_dir.rstrip('/')}/{table}/{table}_*.csv"


def list_drops(spark: SparkSession, raw_dir: str, table: str) -> DataFrame | None:
    """(path, file_path) of a table's drops, None when there are none. File contents are not read."""
    pattern = drop_pattern(raw_dir, table)
    if not any_match(spark, pattern):
        return None
    return listed(spark.read.format("binaryFile").load(pattern))


def listed(files: DataFrame) -> DataFrame:
    """``path`` opens the file, ``file_path`` is its identity in lineage columns and in the load log."""
    return files.select("path", F.col("_metadata.file_path").alias("file_path"))


def _names_a_column(line: Column, spec: TableSpec) -> Column:
    return reduce(Column.__or__, [line.contains(name) for name in spec.names])


def describe_files(spark: SparkSession, paths: list[str], spec: TableSpec) -> DataFrame:
    """(file_path, header, multiline) per file, in one scan that keeps only the lines of interest.

    ``header`` is the first line naming a known column. A line with an odd number of quotes belongs to a
    record that spans lines; only files having one need their lines put together, the others are read as they are.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("position"),
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    header_like = _names_a_column(F.col("value"), spec)
    return (
        lines.where(header_like | (quotes % 2 == 1))
        .groupBy("file_path")
        .agg(
            F.min_by(F.when(header_like, F.col("value")), F.when(header_like, F.col("position"))).alias("header"),
            F.bool_or(quotes % 2 == 1).alias("multiline"),
        )
    )


def _header_names(header: str | None) -> list[str]:
    if header is None:
        return []
    return next(csv.reader([header.removeprefix("\ufeff")]))


def _records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records that may span lines, read in parallel: (file_path, _block_start, _row_id, record) without headers.

    A line break inside a field leaves an odd number of quotes before it in the file. Quotes are counted per block of a
    file, summed over the blocks before, and run on inside a block; so each block finds its records on its own, and
    only lines of records that span lines are brought together. The lines are written once with their counts: the file
    itself is read once.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row_id"),
        "value",
        ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).alias("_odd"),
    )
    path = fresh_dir(spark, "csv-lines")
    lines.write.parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    # One row per block, from the counts alone.
    blocks = lines.groupBy("file_path", "_block_start").agg(F.sum("_odd").alias("_held"))
    earlier = Window.partitionBy("file_path").orderBy("_block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file_path", "_block_start", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    above = Window.partitionBy("file_path", "_block_start").orderBy("_row_id").rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.join(blocks, ["file_path", "_block_start"]).withColumn(
        "_before", F.col("_before") + F.coalesce(F.sum("_odd").over(above), F.lit(0))
    )
    whole = (F.col("_before") % 2 == 0) & (F.col("_odd") == 0)
    alone = counted.where(whole).select("file_path", "_block_start", "_row_id", F.col("value").alias("record"))
    # Two odd lines, and what lies between them, make a record; it stands where the first one does.
    parts = F.sort_array(F.collect_list(F.struct("_block_start", "_row_id", "value")))
    joined = counted.where(~whole).groupBy("file_path", F.floor(F.col("_before") / 2).alias("_number")).agg(parts.alias("_parts"))
    first = F.element_at("_parts", 1)
    joined = joined.select(
        "file_path", first["_block_start"].alias("_block_start"), first["_row_id"].alias("_row_id"),
        F.concat_ws("\n", F.transform("_parts", lambda part: part["value"])).alias("record"),
    )
    records = alone.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")
    head = records.groupBy("file_path").agg(F.min(F.struct("_block_start", "_row_id")).alias("_head"))
    return records.join(head, "file_path").where(F.struct("_block_start", "_row_id") != F.col("_head")).drop("_head")


def _read_group(
    spark: SparkSession, paths: list[str], header: str | None, multiline: bool, spec: TableSpec
) -> DataFrame:
    """Files that share one header: positions are named by it, then the spec's columns picked by name.

    ``_block_start`` and ``_row_id`` order the rows of a file.
    """
    names = _header_names(header)
    # The first of equal names counts; the schema itself needs distinct ones.
    positions = [n if n in spec.columns and n not in names[:i] else f"_extra_{i}" for i, n in enumerate(names)]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in positions or ["_extra_0"]])
    blank = F.lit("")
    if multiline:
        layout = ", ".join(f"`{f.name}` string" for f in schema)
        rows = _records(spark, paths).withColumn("_r", F.from_csv("record", layout, {"escape": '"', "multiLine": "true"}))
        values = "_r."
        place = [F.col("file_path").alias("_source_file"), F.col("_block_start"), F.col("_row_id")]
    else:
        rows = spark.read.schema(schema).options(header=True, escape='"', enforceSchema=True).csv(paths)
        values = ""
        place = [
            F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_block_start").alias("_block_start"),
            F.monotonically_increasing_id().alias("_row_id"),
        ]
    return rows.select(
        *[(F.coalesce(F.col(f"{values}{c}"), blank) if c in positions else blank).alias(c) for c in spec.names], *place
    )


def read_drops(spark: SparkSession, files: list[tuple[str, str]], spec: TableSpec) -> DataFrame:
    """All rows of the given (path, file_path) files as text, blank for a missing column or value.

    One read per distinct (header, multiline) layout, of which there are few however many files arrive.
    """
    layouts = {
        row.file_path: (row.header, row.multiline)
        for row in describe_files(spark, [path for path, _ in files], spec).toLocalIterator()
    }
    groups: dict[tuple[str | None, bool], list[str]] = {}
    for path, file_path in files:
        groups.setdefault(layouts.get(file_path, (None, False)), []).append(path)
    parts = [_read_group(spark, paths, header, multi, spec) for (header, multi), paths in groups.items()]
    return reduce(DataFrame.unionByName, parts).select(
        *spec.names,
        "_source_file",
        batch_ts(F.col("_source_file"), spec.name).alias("_batch_ts"),
        "_block_start",
        "_row_id",
    )
