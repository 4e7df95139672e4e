"""Dated CSV extracts: ``{root}/{table}/{yyyy-mm-dd}/*.csv``.

Values are landed and scanned as text and cast once, in staging, so that an id keeps its
leading zeros. Columns are matched by name: days with the same header are read together,
and the groups are united by name.
"""

from __future__ import annotations

import re
import warnings
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martwright.functions.frames import for_each
from martwright.sources import records

# Fixed value: the day folder directly above the file.
EXTRACT_DATE = r"/([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+$"

_DIALECT = {"header": True, "quote": '"', "escape": '"'}
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
_FILES = {"pathGlobFilter": "*.csv"}


def extract_date(path: Column | None = None) -> Column:
    """Date of the day folder a file lies in; '' where the path has none."""
    return F.regexp_extract(F.col("_metadata.file_path") if path is None else path, EXTRACT_DATE, 1)


def land(df: DataFrame, root: str, table: str, run_date: date | str, rows_per_file: int = 1_000_000) -> str:
    """Write one day's extract. The same day is replaced, other days stay.

    ``rows_per_file`` bounds what a task that fails writes again.
    """
    path = f"{root}/{table}/{run_date}"
    writer = df.write.mode("overwrite").options(**_DIALECT, **_KEEP_SPACES)
    writer.option("maxRecordsPerFile", rows_per_file).csv(path)
    return path


def extract_days(spark: SparkSession, root: str, table: str) -> dict[str, list[str]]:
    """Landed days and their folders; folders that aren't named after a day come under ''.

    Only folder names are listed: a table may have far more files than the driver should hold.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{table}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        raise FileNotFoundError(f"no extract under {root}/{table}")
    days: dict[str, list[str]] = {}
    for entry in files.listStatus(path):
        if entry.isDirectory():
            folder = entry.getPath().toString()
            found = re.search(EXTRACT_DATE, f"{folder}/any file")
            days.setdefault(found.group(1) if found else "", []).append(folder)
    return days


def scan_extracts(spark: SparkSession, root: str, table: str, dates: list[str] | None = None) -> DataFrame:
    """Rows of all landed days (or of ``dates``) as text, with ``filename`` and ``extract_date``.

    One scan per distinct header, however many days there are. A column some days lack is
    NULL there.
    """
    days = extract_days(spark, root, table)
    wanted = [folders for day, folders in days.items() if dates is None or day in dates]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for header, folders in zip(for_each(wanted, lambda folders: _header(spark, folders)), wanted):
        if header:
            by_header.setdefault(header, []).extend(folders)
    if not by_header:
        raise FileNotFoundError(f"no extract with a header under {root}/{table}")
    scans = [_read(spark, header, folders) for header, folders in by_header.items()]
    united = scans[0]
    for scan in scans[1:]:
        united = united.unionByName(scan, allowMissingColumns=True)
    data = [c for c in united.columns if c not in ("filename", "extract_date")]
    return united.select(*data, "filename", "extract_date")


def header_drift(spark: SparkSession, root: str, table: str) -> DataFrame:
    """``from_day, to_day, days, columns, came, went, moved``: the intervals of days with the same header.

    ``came`` and ``went`` are columns that the interval has and the one before it hasn't, and the other way
    round; ``moved`` are those of both that stand at another place among them. Days without a header are left
    out. One header per day is read."""
    days = [(day, folders) for day, folders in sorted(extract_days(spark, root, table).items()) if day]
    headers = for_each(days, lambda day: _header(spark, day[1]))
    rows = [(day, list(header)) for (day, _), header in zip(days, headers) if header]
    named = spark.createDataFrame(rows, "day string, columns array<string>")
    by_day = Window.orderBy("day")  # a row per day
    opens = ~F.lag("columns").over(by_day).eqNullSafe(F.col("columns"))
    spans = named.withColumn("span", F.sum(opens.cast("int")).over(by_day)).groupBy("span", "columns")
    found = spans.agg(F.min("day").alias("from_day"), F.max("day").alias("to_day"), F.count("*").alias("days"))
    before = F.coalesce(F.lag("columns").over(Window.orderBy("from_day")), F.col("columns"))
    both = found.withColumn("before", before).withColumns(
        {"now": F.array_intersect("columns", "before"), "then": F.array_intersect("before", "columns")}
    )
    moved = F.filter("now", lambda c: F.array_position("now", c) != F.array_position("then", c))
    return both.select(
        "from_day",
        "to_day",
        "days",
        "columns",
        F.array_except("columns", "before").alias("came"),
        F.array_except("before", "columns").alias("went"),
        moved.alias("moved"),
    )


def scan_latest(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of the newest day that has rows.

    Warns if the newest folder has no rows and an older day is taken instead.
    """
    return latest_day(spark, root, table)[1]


def latest_day(spark: SparkSession, root: str, table: str) -> tuple[str, DataFrame]:
    """The day that ``scan_latest`` takes, and its rows.

    Walks back over the day folders, so older days are neither listed nor read, however many
    there are.
    """
    days = extract_days(spark, root, table)
    scan, taken, newest = None, "", max(days, default="")
    for day in sorted(days, reverse=True):
        header = _header(spark, days[day])
        if header:
            scan, taken = _read(spark, header, days[day]), day
            if not _by_line(spark, header, days[day]).isEmpty():  # a line after the header is enough
                if day != newest:
                    warnings.warn(f"{table}: no rows found in the folder of {newest}; the extract of {day} is taken")
                return day, scan
    if scan is None:
        raise FileNotFoundError(f"no extract with a header under {root}/{table}")
    return taken, scan


def latest_only(df: DataFrame, extract_day: str = "extract_date") -> DataFrame:
    """Rows of the latest ``extract_day`` of a frame that is partitioned by it.

    Extracts as landed have ``scan_latest``, which parses no other day. The date is fetched first and
    then compared as a literal, which prunes files and partitions; a maximum over a window would
    bring all rows to one task.
    """
    latest = df.agg(F.max(extract_day)).first()[0]
    return df.filter(F.col(extract_day) == F.lit(latest))


def landed_counts(spark: SparkSession, root: str, table: str, dates: list[str] | None = None) -> DataFrame:
    """Rows landed per day. Rows are parsed: a quoted newline doesn't count as one more."""
    return scan_extracts(spark, root, table, dates).groupBy("extract_date").agg(F.count("*").alias("row_count"))


def _header(spark: SparkSession, folders: list[str]) -> tuple[str, ...]:
    """Column names of a day, from the first line of its files; none if they are all empty."""
    try:
        return tuple(spark.read.options(**_DIALECT, **_FILES).csv(folders).columns)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return ()


def _read(spark: SparkSession, header: tuple[str, ...], folders: list[str]) -> DataFrame:
    """Folders that share ``header``. Spark maps CSV columns by position, so a file whose header
    differs must raise (``enforceSchema`` off) rather than swap its columns silently.

    All files are split between tasks. Lines are looked at first, now and not when the rows are read: if none
    can be part of a record over lines, all files are read line by line, in one scan. Else quotes are counted;
    where a record spans lines, the file's records are put together by ``records.spanning_records``, all others
    are read line by line. What a file holds decides, not its size, and each file for itself.
    """
    columns = [F.col(f"`{name}`") for name in header]
    lines = records.raw_lines(spark, folders, **_FILES)
    if not records.any_spanning(lines):
        path = F.col("_metadata.file_path")
        return _by_line(spark, header, folders).select(
            *columns, path.alias("filename"), extract_date(path).alias("extract_date")
        )
    ranges = records.spanning_ranges(lines)
    spanning_files = ranges.select(F.col("path").alias("__file")).distinct()
    by_line = _by_line(spark, header, folders).select(*columns, F.col("_metadata.file_path").alias("__file"))
    by_line = by_line.join(F.broadcast(spanning_files), "__file", "left_anti")
    quoting = {name: _DIALECT[name] for name in ("quote", "escape")}
    spanning = records.parsed(records.spanning_records(lines, ranges), header, **quoting)
    return by_line.unionByName(spanning).select(
        *columns, F.col("__file").alias("filename"), extract_date(F.col("__file")).alias("extract_date")
    )


def _by_line(spark: SparkSession, header: tuple[str, ...], folders: list[str]) -> DataFrame:
    schema = StructType([StructField(name, StringType()) for name in header])
    return spark.read.options(**_DIALECT, **_FILES, enforceSchema=False).schema(schema).csv(folders)
