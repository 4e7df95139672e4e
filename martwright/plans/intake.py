"""Intake of new day folders by a stream that ends: Structured Streaming remembers which files it has seen.

A micro-batch holds the names of new files, never their content. Their days are merged into the history in
order; a day that is older than the last one taken is spliced in, so the order in which folders arrive doesn't
matter. A batch that fails is given again when the stream is started again; days that were taken meanwhile are
passed over, so the history is the same as without the failure.

    intake/<table>/taken                          a row per day that counts, with its number
    intake/<table>/versions/seq=<n>/kept_as=*     versions left open by the n-th day taken, versions closed by
                                                  it, and closed versions of earlier ones that are gone
    intake/<table>/checkpoint                     of the stream
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from martwright.functions.audit import timestamp
from martwright.operators.history import assert_unique_key, first_load, merge_open, next_seen, splice_changes
from martwright.plans.dimensions import NATURAL_KEYS, TRACKED
from martwright.schemas import SOURCES, TIMESTAMP, VALID_TO, VERSION_ID, conform, history_schema
from martwright.sources.landing import extract_date, scan_extracts

_TAKEN = StructType([StructField("day", StringType()), StructField("seq", LongType()), StructField("run_ts", TIMESTAMP)])
#: What Spark's reader of binary files gives; only the path is read.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def at_two_next_day(day: str) -> datetime:
    """The time of the run that takes a day in."""
    return datetime.fromisoformat(day) + timedelta(days=1, hours=2)


@dataclass
class Intake:
    """The history of one source, taken in from ``{root}/raw/{table}/{day}``."""

    spark: SparkSession
    root: str
    table: str
    run_time: Callable[[str], datetime] = at_two_next_day

    def __post_init__(self) -> None:
        self.key, self.tracked = NATURAL_KEYS[self.table], TRACKED[self.table]
        self.base = f"{self.root.rstrip('/')}/intake/{self.table}"

    def run(self, files_per_batch: int | None = None) -> None:
        """Take in all days that have come, and end. A day's files should be put in place at once.

        ``files_per_batch`` bounds a micro-batch; files that come after their day was taken are warned of."""
        reader = self.spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.csv")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        days = reader.load(f"{self.root.rstrip('/')}/raw/{self.table}/*").select(extract_date(F.col("path")).alias("day"))
        writer = days.writeStream.foreachBatch(self._take_batch).trigger(availableNow=True)
        writer.option("checkpointLocation", f"{self.base}/checkpoint").start().awaitTermination()

    def _take_batch(self, batch: DataFrame, _: int) -> None:
        days = sorted(row.day for row in batch.distinct().collect())  # names of day folders
        taken = {row.day for row in self.taken().select("day").collect()}
        for day in days:
            if day in taken:
                warnings.warn(f"{self.table}: files of {day} came again or late; the day stays as it was taken")
            elif day:
                self.take(day)

    def taken(self) -> DataFrame:
        """``day, seq, run_ts`` of the days that count."""
        return self._read(_TAKEN, f"{self.base}/taken")

    def take(self, day: str) -> None:
        """Merge one day, or splice it in if a later one was taken already."""
        last = self.taken().orderBy(F.desc("seq")).limit(1).collect()
        newest = self.taken().agg(F.max("run_ts")).first()[0]
        seq, at = (last[0].seq + 1 if last else 1), self.run_time(day)
        staged = conform(scan_extracts(self.spark, f"{self.root.rstrip('/')}/raw", self.table, [day]), SOURCES[self.table])
        assert_unique_key(staged, self.key)
        if not last:
            versions = first_load(staged, self.key, at)
        elif at > newest:
            versions = merge_open(self._open(last[0].seq), staged, self.key, self.tracked, at)
        else:
            versions = self._spliced(staged, last[0].seq, at)
        gone = F.col("gone") if "gone" in versions.columns else F.lit(False)
        kept_as = F.when(gone, "gone").when(F.col(VALID_TO).isNull(), "open").otherwise("closed")
        rows = versions.withColumn("kept_as", kept_as).drop("gone")
        rows.write.mode("overwrite").partitionBy("kept_as").parquet(f"{self.base}/versions/seq={seq}")
        # From here on the day counts.
        self.spark.createDataFrame([(day, seq, at)], _TAKEN).coalesce(1).write.mode("append").parquet(f"{self.base}/taken")

    def _spliced(self, staged: DataFrame, last: int, at: datetime) -> DataFrame:
        """Versions open after ``staged`` was spliced in, those it closed, and those closed before that go."""
        following = next_seen(self._extracts_after(at), staged, self.key, "run_ts", at)
        changes = splice_changes(self.history(), staged, following, self.key, self.tracked, at)
        names = history_schema(self.table).names
        out = changes.filter("removed").select(F.col(VERSION_ID).alias("__id"))
        still = self._open(last).join(out, F.col(VERSION_ID) == F.col("__id"), "left_anti")
        moved = changes.filter(~F.col("removed") | F.col(VALID_TO).isNotNull()).select(*names, F.col("removed").alias("gone"))
        return moved.unionByName(still.select(*names, F.lit(False).alias("gone")))

    def _extracts_after(self, at: datetime) -> DataFrame:
        """Rows of the taken days after ``at``, with the time of their run."""
        later = self.taken().filter(F.col("run_ts") > timestamp(at)).select("day", "run_ts")
        days = [row.day for row in later.collect()]  # names of day folders
        rows = scan_extracts(self.spark, f"{self.root.rstrip('/')}/raw", self.table, days)
        stamped = rows.join(later.withColumnRenamed("day", "extract_date"), "extract_date")
        return conform(stamped, StructType([*SOURCES[self.table].fields, StructField("run_ts", TIMESTAMP)]))

    def history(self) -> DataFrame:
        """All versions as of the last day taken."""
        names = history_schema(self.table).names
        numbered = StructType([*history_schema(self.table).fields, StructField("seq", LongType())])
        base = f"{self.base}/versions"
        closed, gone = (
            self._read(numbered, f"{base}/seq=*/kept_as={kind}", basePath=base).join(self.taken().select("seq"), "seq", "left_semi")
            for kind in ("closed", "gone")
        )
        went = gone.select(F.col(VERSION_ID).alias("__id"), F.col(VALID_TO).alias("__to"), F.col("seq").alias("__seq"))
        same = (F.col(VERSION_ID) == F.col("__id")) & (F.col(VALID_TO) == F.col("__to")) & (F.col("seq") < F.col("__seq"))
        last = self.taken().agg(F.max("seq")).first()[0]
        return closed.join(went, same, "left_anti").select(*names).unionByName(self._open(last))

    def _open(self, seq: int | None) -> DataFrame:
        return self._read(history_schema(self.table), f"{self.base}/versions/seq={seq}/kept_as=open")

    def _read(self, schema: StructType, path: str, **options: str) -> DataFrame:
        """Parquet at ``path``, or no rows where nothing was written."""
        try:
            return self.spark.read.schema(schema).options(**options).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
