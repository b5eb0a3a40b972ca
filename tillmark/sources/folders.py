"""Folder listings on whatever file system the path names.

Runs write to folders numbered from 0 without gaps. A run's folder counts once Spark's _SUCCESS marker is in it, and
a run that was cut off is repeated under its number, so the finished ones are always the first. The last is found by
probing a few markers, as many as its number has digits in base two; no folder of an old run is opened or listed.
Snapshots and the like have gaps in their numbers, and few folders: those are listed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path_and_fs(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def any_match(spark: SparkSession, pattern: str) -> bool:
    path, fs = _path_and_fs(spark, pattern)
    return bool(fs.globStatus(path))


def _numbers(spark: SparkSession, root: str, label: str) -> list[int]:
    path, fs = _path_and_fs(spark, root)
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(int(name.removeprefix(f"{label}=")) for name in names if name.startswith(f"{label}="))


def _is_finished(spark: SparkSession, root: str, label: str, number: int) -> bool:
    path, fs = _path_and_fs(spark, f"{root}/{label}={number}/_SUCCESS")
    return fs.exists(path)


def last_finished(spark: SparkSession, root: str, label: str, before: int | None = None) -> int:
    """The highest finished run, below ``before`` if given; -1 when there is none."""
    done, step = -1, 1
    while _is_finished(spark, root, label, done + step):
        done += step
        step *= 2
    while step > 1:
        step //= 2
        if _is_finished(spark, root, label, done + step):
            done += step
    return done if before is None else min(done, before - 1)


def finished_runs(spark: SparkSession, root: str, label: str, after: int = -1, before: int | None = None) -> list[int]:
    """Numbers n, after < n < before, of the finished runs."""
    return list(range(after + 1, last_finished(spark, root, label, before) + 1))


def adopt(spark: SparkSession, source: str, target: str) -> None:
    """Make the files that were written to `source` a finished run: moved, in place of what the target held, then marked."""
    path, fs = _path_and_fs(spark, target)
    fs.delete(path, True)
    fs.mkdirs(path.getParent())
    if not fs.rename(_path_and_fs(spark, source)[0], path):
        raise OSError(f"{source} could not be moved to {target}")
    fs.create(_path_and_fs(spark, f"{target}/_SUCCESS")[0], True).close()


def last_with_gaps(spark: SparkSession, root: str, label: str, before: int | None = None) -> int:
    """The highest finished number where numbers may be missing; -1 when there is none."""
    for number in reversed(_numbers(spark, root, label)):
        if (before is None or number < before) and _is_finished(spark, root, label, number):
            return number
    return -1
