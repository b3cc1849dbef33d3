"""One warehouse per session and input folder, written on first use.

The reports read a loaded warehouse, so the registered queries do too: each table is
derived from the given tables once, written below the shared folder and read back.
Only the tables a query needs are built.
"""

from __future__ import annotations

from functools import cached_property
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.operators.cleaning import clean_sales
from ledgerstar.operators.fact import FACT_PARTITION, fact_sales
from ledgerstar.plans.load import load_dimensions, load_warehouse
from ledgerstar.plans.star import Star
from ledgerstar.schemas import DIMENSION_KEYS
from ledgerstar.sources import landing
from ledgerstar.sources.parts import PartSet, replace_parts
from ledgerstar.sources.retail_tables import raw_sales, state_of
from ledgerstar.sources.tables import read_star, shared_folder, store
from ledgerstar.sources.versions import new_version

LOAD_TIME = "2024-01-01 00:00:00"
PART_ROWS = 5000
VOLUME_ROWS = 250_000
ODD_NAMES = ("blank in it.csv", "50%25 + more.csv", "a#b+c.csv", "plain.csv")
_open: dict[tuple[str, str], "Workspace"] = {}


class Workspace:
    """Quacks like a Star; every table is built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        tag = sha256(folder.encode()).hexdigest()[:8]
        self.root = f"{shared_folder(spark)}/ledgerstar-{spark.sparkContext.applicationId}-{tag}"

    def fresh(self, name: str) -> str:
        return f"{self.root}/{name}-{new_version()}"

    @property
    def state(self):
        return state_of(F.col("store_location"))

    def raw(self) -> DataFrame:
        return raw_sales(self.spark, self.folder)

    @cached_property
    def parts(self) -> str:
        """Folder of landed CSV parts, packed."""
        path = self.fresh("parts")
        landing.write_parts(self.raw().drop("source_file", "staging_key"), path, PART_ROWS, packed=True)
        return path

    @cached_property
    def named_parts(self) -> str:
        """Landed parts, all rows of one source file in a folder that bears its name."""
        path = self.fresh("named-parts")
        rows = self.raw().drop("staging_key").withColumnRenamed("source_file", "of_file")
        rows.repartition("of_file").write.partitionBy("of_file").options(**landing.CSV_OPTIONS).csv(path)
        return path

    @cached_property
    def odd_parts(self) -> str:
        """Landed files of four odd names in numbered volumes; two names have other headers in another order.

        The rows of a name go on from volume to volume in the order of staging, so that no task
        writes or reads more than a volume or a range, whatever a name holds.
        """
        path = self.fresh("odd-parts")
        lines = self.spark.read.parquet(f"{self.folder}/lineitem.parquet").count()
        partitions = max(1, -(-lines // VOLUME_ROWS))
        rows = self.raw().withColumn("n", F.split(F.trim("Invoice Line No"), "-")[1].cast("long") % len(ODD_NAMES))
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        files = hadoop.Path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for turned in (0, 1):
            numbers = range(turned, len(ODD_NAMES), 2)
            mine = rows.where(F.col("n").isin(*numbers)).repartitionByRange(partitions, "n", "staging_key")
            mine = mine.sortWithinPartitions("n", "staging_key").drop("source_file", "staging_key")
            if turned:
                mine = mine.select(*reversed(mine.columns)).withColumnRenamed("Store", "store_number")
            landing.write_parts(mine, f"{path}/tmp{turned}", VOLUME_ROWS, by="n")
            written = landing.list_files(self.spark, f"{path}/tmp{turned}", "*.csv")
            for number in numbers:
                volumes = [f for f in written if f"/n={number}/" in f]
                if not volumes:  # a name without rows is a file with a header
                    landing.write_parts(mine.drop("n").limit(0), f"{path}/tmp{turned}/none{number}", VOLUME_ROWS)
                    volumes = landing.list_files(self.spark, f"{path}/tmp{turned}/none{number}", "*.csv")
                for volume, file in enumerate(volumes):
                    target = hadoop.Path(f"{path}/volume={volume:06d}", ODD_NAMES[number])
                    files.mkdirs(target.getParent())
                    files.rename(hadoop.Path(file), target)
            files.delete(hadoop.Path(f"{path}/tmp{turned}"), True)
        return path

    @cached_property
    def part_set(self) -> PartSet:
        """A set of parts that has taken the place of an earlier one of other days.

        The rows are written once and read for both sets, so lines meet their orders once.
        """
        root = self.fresh("part-set")
        rows = store(self.raw().drop("source_file", "staging_key"), self.fresh("landed"))
        replace_parts(rows, root, "1996-01-01", "1996-12-31", PART_ROWS)
        return replace_parts(rows, root, "1990-01-01", "2010-12-31", PART_ROWS)

    @cached_property
    def staging(self) -> DataFrame:
        stamp = F.lit(LOAD_TIME).cast("timestamp")
        return store(clean_sales(self.raw(), stamp), self.fresh("staging"))

    @cached_property
    def _dims(self) -> tuple[dict[str, DataFrame], DataFrame]:
        return load_dimensions(self.staging, self.state, self.fresh)

    @cached_property
    def fact(self) -> DataFrame:
        lines = fact_sales(self.staging, self._dims[1])
        return store(lines, self.fresh("fact"), by=FACT_PARTITION, rows=self.staging.count())

    @cached_property
    def warehouse(self) -> str:
        """Folder of a whole load: written, checked and published."""
        root = self.fresh("warehouse")
        load_warehouse(
            self.spark, self.raw(), root, self.state, F.lit(LOAD_TIME).cast("timestamp")
        )
        return root

    @cached_property
    def published(self) -> Star:
        return read_star(self.spark, self.warehouse)

    def dimension(self, name: str) -> DataFrame:
        return self._dims[0][name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in DIMENSION_KEYS:
            return self.dimension(name)
        raise AttributeError(name)


def open_workspace(spark: SparkSession, folder: str) -> Workspace:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        _open[key] = Workspace(spark, folder)
    return _open[key]
