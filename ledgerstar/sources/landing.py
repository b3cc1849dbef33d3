"""Landed CSV parts, their manifest, and the county outlines."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerstar.functions.text import column_name
from ledgerstar.schemas import COLUMN_ALIASES

MANIFEST_SCHEMA = (
    "generated_at_utc string, start_date string, end_date string, `limit` int, "
    "file_count bigint, total_rows bigint, files array<string>"
)
PART_PATTERN = "*part*.csv"
# How text with quotes, blanks and line ends is written and read: quotes are doubled.
CSV_OPTIONS = {
    "header": True, "escape": '"', "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def list_files(spark: SparkSession, folder: str | list[str], pattern: str = PART_PATTERN) -> list[str]:
    """Paths only: the binary source never opens a file whose content is not selected."""
    found = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    )
    return sorted(r.path for r in found.collect())


def _list_if_there(spark: SparkSession, folder: str) -> list[str]:
    try:
        return list_files(spark, folder, "*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def decoded(path: str | Column) -> Column:
    """A URL-encoded path as it is on disk; a plus stands for itself there."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def base_name(path: Column) -> Column:
    """Name on disk of the file at a URL-encoded path."""
    return decoded(F.element_at(F.split(path, "/"), -1))


def _place(path: str) -> str:
    """A path without scheme and host, as different file systems spell the same file."""
    return urlsplit(path).path if "://" in path or path.startswith("file:") else path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)


def find_raw_files(
    spark: SparkSession, folder: str, manifest: str | None = None, pattern: str = PART_PATTERN
) -> list[str]:
    """Files the manifest names, as far as they exist; without any, all sorted parts."""
    if manifest:
        try:
            row = read_manifest(spark, manifest).first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            row = None
        named = list(row.files or []) if row else []
        named = [p if "/" in p else f"{folder.rstrip('/')}/{p}" for p in named]
        folders = sorted({p.rsplit("/", 1)[0] for p in named})
        there = {_place(p) for f in folders for p in _list_if_there(spark, f)}
        existing = [p for p in named if _place(p) in there]
        if existing:
            return existing
    return list_files(spark, folder, pattern)


VOLUME_SPAN = 1 << 42


def read_raw(spark: SparkSession, paths: list[str], multi_line: bool = True) -> DataFrame:
    """All columns as text, blanks as empty text, plus source_file, source_position and staging_key.

    The parts of one call share a header; Spark compares each file's header and fails
    on a different one (`read_extracts` reads parts with different headers).
    Embedded line breaks need multi_line, which keeps a file in one task: right for
    parts bounded by the page size. Large files without such breaks are split with
    multi_line=False.

    source_position grows along a file: block start plus row number in the task, since a task
    never holds more rows than a block has bytes. (source_file, source_position) is the order
    of landing, taken from each row's own metadata: no listing is joined. Files that share a name
    go on one after the other if their folders are numbered `volume=0`, `volume=1` and so on; a
    volume is given VOLUME_SPAN positions. staging_key only tells rows apart.
    """
    if not paths:
        raise FileNotFoundError("no landed CSV files")
    lines = csv_lines(spark, paths, multi_line=multi_line)
    row = F.monotonically_increasing_id()
    place = F.col("_metadata.file_block_start") + row.bitwiseAND(F.lit((1 << 33) - 1))
    volume = F.regexp_extract(F.col("_metadata.file_path"), "/volume=([0-9]{1,6})/[^/]*$", 1).try_cast("bigint")
    position = F.coalesce(volume, F.lit(0)) * VOLUME_SPAN + place
    return lines.select(
        *[F.coalesce(named(c), F.lit("")).alias(c) for c in lines.columns],
        base_name(F.col("_metadata.file_path")).alias("source_file"),
        position.alias("source_position"), row.alias("staging_key"),
    )


HEAD_BYTES = 1 << 16


def header_of(spark: SparkSession, path: str) -> str:
    """First line of a file, of which no more than HEAD_BYTES are read."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(place)
    try:
        head = jvm.org.apache.commons.io.IOUtils.toString(
            jvm.org.apache.commons.io.input.BoundedInputStream(stream, HEAD_BYTES), "UTF-8"
        )
    finally:
        stream.close()
    line, end, _ = head.partition("\n")
    if not end and len(head.encode()) >= HEAD_BYTES:
        raise ValueError(f"the header of {path} is longer than {HEAD_BYTES} bytes")
    return line.rstrip("\r")


def read_extracts(spark: SparkSession, paths: list[str], multi_line: bool = True) -> list[DataFrame]:
    """One frame per header among the parts.

    Only the head of each part is read to tell headers apart, several parts at a time; a
    header does not contain line breaks. Names may hold anything but brackets, braces and
    asterisks, which Spark reads as patterns. Clean each frame on its own
    (`cleaning.clean_extracts`), since names and coordinates depend on the columns a part has.
    """
    files = list_files(spark, paths, "*") if paths else []
    if not files:
        raise FileNotFoundError("no landed CSV files")
    with ThreadPoolExecutor(32) as pool:
        heads = list(pool.map(lambda f: header_of(spark, f), files))
    groups: dict[str, list[str]] = {}
    for head, file in zip(heads, files):
        groups.setdefault(head, []).append(file)
    return [read_raw(spark, group, multi_line) for group in groups.values()]


def check_range(start: str, end: str, limit: int) -> None:
    try:
        first, last = (datetime.strptime(d, "%Y-%m-%d") for d in (start, end))
    except ValueError as bad:
        raise ValueError("start and end must be dates like 2023-01-31") from bad
    if first > last:
        raise ValueError("start must not be after end")
    if limit <= 0:
        raise ValueError("limit must be above zero")


def in_range(date: Column, start: str, end: str) -> Column:
    """Inclusive, on the first ten characters as text; no date is out of range."""
    return F.coalesce(F.substring(date, 1, 10).between(start, end), F.lit(False))


def slice_raw(raw: DataFrame, start: str, end: str, must_match: bool = True) -> DataFrame:
    check_range(start, end, limit=1)
    kept = raw.where(in_range(F.col("date"), start, end))
    if must_match and kept.isEmpty():
        raise FileNotFoundError(f"no landed rows between {start} and {end}")
    return kept


def write_parts(raw: DataFrame, folder: str, limit: int, packed: bool = False, by: str | None = None) -> None:
    """CSV parts of at most limit rows in a new folder; the commit is all or nothing.

    With `by`, a folder for each value of that column, which the rows are sorted by. Packed parts
    are written with gzip at its fastest level and end in .csv.gz; they cannot be split, so limit bounds a reader's task.
    """
    writer = raw.write.mode("errorifexists").options(**CSV_OPTIONS).option("maxRecordsPerFile", limit)
    writer = writer.option("compression", "gzip" if packed else "none").option("zlib.compress.level", "BEST_SPEED")
    (writer if by is None else writer.partitionBy(by)).csv(folder)


def rows_per_file(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))


def named(column: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col(f"`{column.replace('`', '``')}`")


def column_called(raw: DataFrame, name: str) -> Column:
    """The landed column that conforms to the staging name; nulls where there is none."""
    for c in raw.columns:
        conformed = column_name(c)
        if COLUMN_ALIASES.get(conformed, conformed) == name:
            return named(c)
    return F.lit(None).cast("string")


def day_of(date: Column) -> Column:
    """The first ten characters, null for a blank."""
    return F.nullif(F.substring(date, 1, 10), F.lit(""))


def csv_lines(
    spark: SparkSession, paths: list[str] | str, columns: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """A scan of landed parts as text; with `columns` no part is opened to learn its header."""
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).option("enforceSchema", False)
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c.replace('`', '``')}` string" for c in columns))
    return reader.csv(paths)


def manifest_of(lines: DataFrame) -> DataFrame:
    """file, rows, dated_rows, first_day, last_day of every file with rows in a file scan, by one pass."""
    day = day_of(column_called(lines, "date"))
    return (
        lines.select(F.col("_metadata.file_path").alias("file"), day.alias("day"))
        .groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"), F.count("day").alias("dated_rows"),
            F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        )
    )


def file_manifest(
    spark: SparkSession, paths: list[str] | str, multi_line: bool = True, pattern: str = "*"
) -> DataFrame:
    """The manifest of landed files as a table, files without rows included.

    Files are listed by the binary source, which opens none, and joined to one scan's counts.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(paths)
    listed = listed.select(F.col("_metadata.file_path").alias("file"))
    counted = manifest_of(csv_lines(spark, paths, multi_line=multi_line))
    return listed.join(counted, "file", "left").select(
        "file", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("rows", "dated_rows")], "first_day", "last_day"
    )


def extract_manifest(
    spark: SparkSession, paths: list[str], start: str, end: str, limit: int,
    multi_line: bool = True,
) -> DataFrame:
    """One row describing an extract: its range, its files in order of name, its number of rows.

    The array of files is what this format asks for; `file_manifest` has a row for each.
    """
    if paths:
        files = file_manifest(spark, paths, multi_line).select(decoded("file").alias("file"), "rows")
    else:
        files = spark.createDataFrame([], "file string, rows bigint")
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                          "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return files.agg(
        F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.array_sort(F.collect_list("file")).alias("files"),
    ).select(
        stamp.alias("generated_at_utc"),
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        F.lit(limit).alias("limit"),
        "file_count", "total_rows", "files",
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").json(path)


def write_csv(report: DataFrame, path: str) -> None:
    """Report export with a header; quotes are doubled and blanks kept."""
    report.write.mode("errorifexists").options(**CSV_OPTIONS).csv(path)


def read_counties(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON county outlines: FIPS, COUNTY and the polygon rings."""
    features = (
        "array<struct<properties: struct<FIPS: string, COUNTY: string>, "
        "geometry: struct<type: string, coordinates: array<array<array<double>>>>>>"
    )
    doc = spark.read.schema(f"features {features}").option("multiLine", True).json(path)
    return doc.select(F.explode("features").alias("f")).select(
        F.col("f.properties.FIPS").alias("fips"),
        F.col("f.properties.COUNTY").alias("county"),
        F.col("f.geometry.coordinates").alias("polygon"),
    )
