"""CSV records that span lines, in files that are split between tasks at any byte.

Whether a line begins inside a quoted value depends on all quotes before it in its file. Spark splits a
file into byte ranges and gives each line to the range it begins in. So quotes are counted per range, and
a running sum over the ranges of a file says how each begins; within a range a running sum over its lines
does the same for them. A record begins with a line outside of quotes. What is cut off at the end of a
range, and the lines before the first record of the next ones, are put together again; that is at most two
pieces per range. No task reads more than a range, and no file names come to the driver.

A quote counts if it stands at the edge of a field and isn't doubled; others are text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Options under which lines end at a newline only; a CR before it is dropped at the end of a record.
_BY_NEWLINE = {"lineSep": "\n"}


def raw_lines(spark: SparkSession, folders: list[str], **options: str) -> DataFrame:
    """``line, path, start, length, seq``: lines of files, the range they begin in, and their order there."""
    found = spark.read.options(**options, **_BY_NEWLINE).text(folders)
    return found.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("seq"),
    )


def edge_quotes(line: str, delimiter: str = ",") -> Column:
    """Quotes that open or close a value: those beside a delimiter or at an end of the line, but doubled ones."""
    bare = F.replace(F.regexp_replace(line, "\r$", ""), F.lit('""'), F.lit(""))
    edge = f'(?<![^{delimiter}])"|"(?![^{delimiter}])'
    return F.when(F.contains(F.col(line), F.lit('"')), F.regexp_count(bare, F.lit(edge))).otherwise(0)


def spans(line: str) -> Column:
    """If a line leaves a quote open, or has a CR inside, which a reader of lines takes for its end."""
    inside = F.contains(F.col(line), F.lit("\r")) & F.col(line).rlike("\r(?!$)")
    return (edge_quotes(line) % 2 == 1) | inside


def any_spanning(lines: DataFrame) -> bool:
    """If there is a file that can't be read line by line: ``spanning_ranges`` has rows. One scan at most, which
    ends at the first such line and groups nothing."""
    return not lines.filter(spans("line")).isEmpty()


def spanning_ranges(lines: DataFrame) -> DataFrame:
    """``path, start, length, before``: the ranges of files that can't be read line by line, and the quotes
    before each.

    Those are files with a line that ``spans``. One row per range of such files: far less than the splits a scan of them keeps on the
    driver, so it may be broadcast."""
    quotes = edge_quotes("line")
    odd = F.max(spans("line")).alias("odd")
    counted = lines.groupBy("path", "start", "length").agg(F.sum(quotes).alias("quotes"), odd)
    of_file = Window.partitionBy("path")
    before = F.sum("quotes").over(of_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    ranged = counted.select(
        "path", "start", "length", F.coalesce(before, F.lit(0)).alias("before"), F.max("odd").over(of_file).alias("spans")
    )
    return ranged.filter("spans").drop("spans")


def spanning_records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """``path, record``: the records, without headers, of the files in ``ranges``; blank lines between records
    are none."""
    files = ranges.select("path").distinct()
    placed = lines.join(F.broadcast(files), "path", "left_semi").join(
        F.broadcast(ranges), ["path", "start", "length"], "left"
    )
    moved = F.raise_error(F.concat(F.lit("split differently when read again: "), F.col("path"))).cast("long")
    placed = placed.withColumn("before", F.coalesce(F.col("before"), moved))
    placed = placed.withColumn("quotes", edge_quotes("line"))

    in_range = Window.partitionBy("path", "start").orderBy("seq")
    earlier = F.sum("quotes").over(in_range.rowsBetween(Window.unboundedPreceding, -1))
    inside = (F.col("before") + F.coalesce(earlier, F.lit(0))) % 2 == 1
    open_after = (F.col("inside").cast("int") + F.col("quotes")) % 2 == 1
    marked = placed.withColumn("inside", inside).filter(F.col("inside") | (F.trim(F.regexp_replace("line", "\r$", "")) != ""))
    numbered = marked.withColumn("number", F.sum((~F.col("inside")).cast("int")).over(in_range))
    pieces = numbered.groupBy("path", "start", "number").agg(
        _put_together("seq", "line").alias("text"), F.max_by(open_after, "seq").alias("open")
    )

    cut = (F.col("number") == 0) | F.col("open")
    header = (F.col("start") == 0) & (F.col("number") == 1)
    whole = pieces.filter(~cut & ~header).select("path", F.col("text").alias("record"))
    of_file = Window.partitionBy("path").orderBy("start", "number")
    begun = pieces.filter(cut).withColumn("head", F.sum((F.col("number") > 0).cast("int")).over(of_file))
    joined = begun.groupBy("path", "head").agg(
        _put_together("start", "number", "text").alias("record"), F.max(header).alias("header")
    )
    return whole.unionByName(joined.filter("NOT header").select("path", "record"))


def _put_together(*columns: str) -> Column:
    """The texts of a group, the last column, in the order of the others, with newlines between."""
    pieces = F.sort_array(F.collect_list(F.struct(*columns)))
    return F.array_join(F.transform(pieces, lambda piece: piece[columns[-1]]), "\n")


def parsed(records: DataFrame, names: tuple[str, ...], **dialect: str) -> DataFrame:
    """Columns ``names`` of records, as text, and their file as ``__file``."""
    fields = ", ".join(f"_{i} string" for i in range(len(names)))
    values = F.from_csv(F.regexp_replace("record", "\r$", ""), fields, dialect)
    rows = records.select(F.col("path").alias("__file"), values.alias("values"))
    return rows.select(*[F.col(f"values._{i}").alias(name) for i, name in enumerate(names)], "__file")
