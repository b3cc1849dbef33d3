"""Part sets: landed CSV parts that are replaced as one, with a manifest that prunes them.

A set is a folder of packed parts in the order of day and invoice line, at most `limit` rows each,
beside a manifest table: one row per part with its rows, its dated rows, and its first and
last day. The set becomes visible with the commit record that is written last
(`versions.VersionLog`); a reader that opened the set before keeps it.

The days of a part are a zone map: a slice of days opens only the parts whose days meet it.
The manifest is a table that is joined and summed up, never a list inside a plan; only the
paths of the parts of a slice reach the driver, where Spark lists what it reads anyway.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.sources import landing
from ledgerstar.sources.landing import column_called, csv_lines, day_of
from ledgerstar.sources.versions import Commit, VersionLog, new_version

MANIFEST_COLUMNS = "file string, rows bigint, dated_rows bigint, first_day string, last_day string"


@dataclass(frozen=True)
class PartSet:
    """One published set; what it reads does not change when another one is published."""

    spark: SparkSession
    folder: str
    commit: Commit

    @property
    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST_COLUMNS).parquet(f"{self.folder}/manifest")

    @property
    def summary(self) -> DataFrame:
        """One row: when and for which days the set was made, its parts and rows."""
        facts, made = self.commit.facts, self.commit.published_at
        totals = self.manifest.agg(
            F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows")
        )
        return totals.select(
            F.lit(f"{made:%Y-%m-%dT%H:%M:%SZ}").alias("generated_at_utc"), F.lit(facts["start"]).alias("start_date"),
            F.lit(facts["end"]).alias("end_date"), F.lit(facts["limit"]).cast("int").alias("limit"), "file_count", "total_rows",
        )

    def _lines(self, paths: list[str] | str) -> DataFrame:
        return csv_lines(self.spark, paths, self.commit.facts["columns"])

    def rows(self) -> DataFrame:
        """All rows, as landed text; blanks are empty text."""
        return _plain(self._lines(f"{self.folder}/parts"))

    def slice(self, start: str, end: str, must_match: bool = True) -> DataFrame:
        """Rows of the days from start to end; parts without such days are not opened."""
        landing.check_range(start, end, limit=1)
        met = self.manifest.where((F.col("first_day") <= end) & (F.col("last_day") >= start))
        paths = [unquote(r.file) for r in met.select("file").collect()]
        if not paths:
            if must_match:
                raise FileNotFoundError(f"no landed rows between {start} and {end}")
            return self.rows().where(F.lit(False))
        lines = _plain(self._lines(paths))
        kept = lines.where(landing.in_range(column_called(lines, "date"), start, end))
        # a part that meets the range may still hold no day within it
        if must_match and kept.isEmpty():
            raise FileNotFoundError(f"no landed rows between {start} and {end}")
        return kept


def _plain(lines: DataFrame) -> DataFrame:
    return lines.select(*[F.coalesce(landing.named(c), F.lit("")).alias(c) for c in lines.columns])


def _log(spark: SparkSession, root: str) -> VersionLog:
    return VersionLog(spark, root, "sets")


def open_parts(spark: SparkSession, root: str) -> PartSet:
    commit = _log(spark, root).newest()
    if commit is None:
        raise FileNotFoundError(f"no published parts under {root}")
    return PartSet(spark, _log(spark, root).path(commit.version), commit)


def replace_parts(raw: DataFrame, root: str, start: str, end: str, limit: int) -> PartSet:
    """Write the rows from start to end as a new set of parts and publish it in place of the old one.

    Rows without a date are left out, as a source asked for a range of days leaves them out.
    A writer that is lost before the record is written leaves the old set as it was.
    """
    landing.check_range(start, end, limit)
    spark = raw.sparkSession
    log = _log(spark, root)
    after, version = log.last_number(), new_version()
    folder = log.path(version)
    date, line = column_called(raw, "date"), column_called(raw, "invoice_and_item_number")
    kept = raw.where(landing.in_range(date, start, end))
    ordered = kept.repartitionByRange(day_of(date), line).sortWithinPartitions(date, line)
    landing.write_parts(ordered, f"{folder}/parts", limit, True)
    parts = csv_lines(spark, f"{folder}/parts", raw.columns)
    landing.manifest_of(parts).write.mode("errorifexists").parquet(f"{folder}/manifest")
    facts = {"start": start, "end": end, "limit": limit, "columns": raw.columns}
    return PartSet(spark, folder, log.publish(version, after, facts))


def refresh_parts(
    spark: SparkSession, root: str, start: str, end: str, limit: int, source: DataFrame | None = None
) -> PartSet:
    """A new set from the source, or, where there is none, from the rows of the published set.

    Parts, slice and manifest are tied together: the set that is published holds exactly the
    days asked for, and its manifest describes it. No row of those days is an error.
    """
    raw = open_parts(spark, root).slice(start, end) if source is None else source
    return replace_parts(raw, root, start, end, limit)


def collect_parts(spark: SparkSession, root: str, grace: timedelta) -> list[str]:
    """Remove sets superseded, or begun and never published, longer ago than `grace`."""
    return _log(spark, root).collect(grace)
