"""Parquet tables of one warehouse, published version by version.

Every load writes into a folder of its own. Only after all tables are written and
the checks have passed is the version published (`versions.VersionLog`), so readers
see the old version whole or the new one whole, and nothing is read and overwritten
at the same path. Of two loads at once only one is published.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS
from ledgerstar.sources.versions import VersionLog

TABLES = ["staging", "fact", *DIMENSION_KEYS]


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by spark.checkpoint.dir.

    Only a session whose executors are threads of the driver (`local[...]`) may leave it
    unset; then a folder of its own below the temporary folder serves.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), f"ledgerstar-{spark.sparkContext.applicationId}")


Measures = tuple[Observation, list[Column]]
# From so many rows on a table with a folder per value is written by the tasks that read its source.
DIRECT_ROWS = 100_000_000


def write_table(
    df: DataFrame, path: str, by: str | None = None, measures: Measures | None = None, rows: int = 0
) -> None:
    """Write a table; with `by`, one folder per value, in files of about the advisory size.

    The rebalance splits a value of many rows over several tasks, and puts values of few
    rows into one. It shuffles the whole table: where `rows`, the number of rows read for it, is large,
    each task that reads them writes a file for every value it holds instead. Measures are taken
    in the tasks that write, of which a finished one counts once, however often it was tried.
    """
    if by is not None and rows < DIRECT_ROWS:
        df = df.hint("rebalance", F.col(by))
    if measures is not None:
        df = df.observe(measures[0], *measures[1])
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    (writer if by is None else writer.partitionBy(by)).parquet(path)


def store(
    df: DataFrame, path: str, by: str | None = None, measures: Measures | None = None, rows: int = 0
) -> DataFrame:
    """Write once and go on from the written table, which cuts the lineage."""
    write_table(df, path, by, measures, rows)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_all(frames: dict[str, DataFrame], path_of: Callable[[str], str]) -> dict[str, DataFrame]:
    """Store independent tables side by side, so that one's tail does not idle the cluster."""
    with ThreadPoolExecutor(len(frames)) as pool:
        stored = pool.map(lambda item: store(item[1], path_of(item[0])), frames.items())
        return dict(zip(frames, stored))


def version_path(root: str, version: str, table: str) -> str:
    return f"{root}/versions/{version}/{table}"


def version_log(spark: SparkSession, root: str) -> VersionLog:
    return VersionLog(spark, root)


def current_version(spark: SparkSession, root: str) -> str | None:
    newest = version_log(spark, root).newest()
    return newest.version if newest else None


def read_star(spark: SparkSession, root: str, version: str | None = None) -> Star:
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no published warehouse under {root}")
    return Star(
        **{t: spark.read.parquet(version_path(root, version, t)) for t in TABLES}
    )


def remove_old_versions(spark: SparkSession, root: str, grace: timedelta) -> list[str]:
    """Remove versions superseded, or begun and never published, longer ago than `grace`.

    `grace` is the time that open readers and running loads are given.
    """
    return version_log(spark, root).collect(grace)
