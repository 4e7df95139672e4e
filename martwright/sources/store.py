"""Where a run keeps its tables, and which run counts.

Every run writes Parquet below its own ``run=<id>`` folders and then adds one row to the
commit log. Readers follow the log, so all tables of a run appear at once, and a run that
failed, or lost executors half-way, leaves nothing anyone reads.

    staging/run=<id>/<table>           conformed extracts
    history/<table>/run=<id>/buckets=<n>/kept_as=*   versions left open, and versions closed in the run,
                                                    in n buckets by key
    marts/run=<id>/<mart>              dimensions; facts in parts, part=<month>, those the run wrote
    parts/run=<id>/<fact>              the parts of a fact as of the run, and the run that wrote each
    commits/                           run id, run time, load time, the extract day taken of each source,
                                       rows landed, staged and in marts, as seen when they were written

A closed version never changes. A run rewrites the open versions only; the closed ones, which
grow for ever, are read but not copied. The same holds for parts of facts that a run doesn't touch.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

from martwright.functions.audit import utc_naive, with_loaded_at
from martwright.functions.frames import counted
from martwright.schemas import MARTS, SOURCES, TIMESTAMP, VALID_TO, history_schema

_COMMITS = StructType(
    [
        StructField("run", StringType()),
        StructField("run_ts", TIMESTAMP),
        StructField("loaded_at", TIMESTAMP),
        StructField("extracts", MapType(StringType(), StringType())),
        StructField("rows", MapType(StringType(), LongType())),
    ]
)

_PARTS = StructType(
    [
        StructField("part", StringType()),
        StructField("rows", LongType()),
        StructField("digest", StringType()),
        StructField("written_by", StringType()),
        StructField("dbt_run_started_at", TIMESTAMP),
    ]
)


#: Rows from which a part is written by all tasks that have some of it.
LARGE_PART = 100_000


@dataclass(frozen=True)
class Commit:
    run: str
    run_ts: datetime
    loaded_at: datetime
    extracts: dict[str, str] | None
    rows: dict[str, int] | None


class Store:
    """``buckets``: in how many a run keeps open versions; as many as the run before, and the first one as many
    as a shuffle has partitions. A run with another number shuffles the history once."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    @staticmethod
    def run_id(run_ts: datetime) -> str:
        return utc_naive(run_ts).strftime("r%Y%m%d%H%M%S%f")

    def log(self) -> DataFrame:
        """Runs that count, one row each. It grows for ever, so it is joined, not collected."""
        return self._read(_COMMITS, f"{self.root}/commits")

    def last_commit(self) -> Commit | None:
        return next((Commit(*row) for row in self.log().orderBy(F.desc("run_ts")).limit(1).collect()), None)

    def commit(
        self, run_ts: datetime, loaded_at: datetime, extracts: dict[str, str], rows: dict[str, int] | None = None
    ) -> None:
        row = [(self.run_id(run_ts), utc_naive(run_ts), utc_naive(loaded_at), extracts, rows or {})]
        self.spark.createDataFrame(row, _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def write_staging(self, run: str, table: str, df: DataFrame) -> int:
        """Returns the number of rows, as ``write_mart`` and ``write_fact`` do."""
        return self._write(df, f"{self.root}/staging/run={run}/{table}")

    def staging(self, run: str, table: str) -> DataFrame:
        return self._read(SOURCES[table], f"{self.root}/staging/run={run}/{table}")

    def committed_staging(self, table: str) -> DataFrame:
        """Staging of all runs that count, with ``run``."""
        staged = self._read(SOURCES[table], f"{self.root}/staging/run=r*/{table}")
        run = F.regexp_extract(F.input_file_name(), "/run=([^/]+)/", 1)
        return staged.select("*", run.alias("run")).join(self.log().select("run"), "run", "left_semi")

    def write_versions(self, run: str, table: str, versions: DataFrame, key: str, last: str | None = None) -> None:
        """Keep what a run made of the open versions: those still open and those it closed.

        They are bucketed by ``key`` as those of the run ``last`` were, so that the merge of the next run needn't
        shuffle the history. Spark writes buckets only for tables of its catalog, so one is there meanwhile."""
        kept_as = F.when(F.col(VALID_TO).isNull(), "open").otherwise("closed")
        before = self._open_folder(last, table) if last else None
        default = before[1] if before else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = self.buckets or default
        name, base = f"martwright_{uuid.uuid4().hex}", f"{self.root}/history/{table}/run={run}"
        self._remove(base)  # what a run that failed has left
        writer = versions.withColumn("kept_as", kept_as).write.format("parquet").mode("overwrite")
        writer = writer.partitionBy("kept_as").bucketBy(buckets, key).sortBy(key)
        try:
            writer.option("path", f"{base}/buckets={buckets}").saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def open_versions(self, run: str, table: str, key: str | None = None) -> DataFrame:
        """Versions a run left open; with ``key``, as a table in buckets by it."""
        schema, found = history_schema(table), self._open_folder(run, table)
        if not found:
            return self.spark.createDataFrame([], schema)
        path, buckets = found
        if not key:
            return self._read(schema, path)
        name = f"martwright_open_{hashlib.md5(path.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        return self.spark.table(name)

    def _open_folder(self, run: str, table: str) -> tuple[str, int] | None:
        """Where a run's open versions lie, and in how many buckets."""
        base = f"{self.root}/history/{table}/run={run}"
        for buckets in self._folders(base, "buckets="):
            if "open" in self._folders(f"{base}/buckets={buckets}", "kept_as="):
                return f"{base}/buckets={buckets}/kept_as=open", int(buckets)
        return None

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _remove(self, path: str) -> None:
        target = self._path(path)
        target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)

    def history(self, run: str, table: str, earlier: bool = True) -> DataFrame:
        """All versions as of ``run``: the open ones it left, and those it and, if ``earlier``, the
        runs that count had closed."""
        closed = StructType(history_schema(table).fields + [StructField("run", StringType())])
        base = f"{self.root}/history/{table}"
        versions = self._read(closed, f"{base}/run=*/buckets=*/kept_as=closed", basePath=base)
        counted = versions.filter(F.col("run") == run)
        if earlier:
            before = versions.filter(F.col("run") != run).join(self.log().select("run"), "run", "left_semi")
            counted = counted.unionByName(before)
        return counted.select(*history_schema(table).names).unionByName(self.open_versions(run, table))

    def write_mart(self, run: str, mart: str, df: DataFrame) -> int:
        return self._write(df, f"{self.root}/marts/run={run}/{mart}")

    def write_fact(self, run: str, mart: str, df: DataFrame, rows_per_part: float = 0) -> int:
        """Keep the parts of a fact that a run wrote; ``df`` has ``part`` and no stamps.

        Small parts are dealt by part, so that a part has few files; AQE splits a large one between tasks. Where a
        part has ``LARGE_PART`` rows on average, each task writes its own file of it, and no row is moved."""
        if rows_per_part < LARGE_PART:
            df = df.hint("rebalance", F.col("part"))
        return self._write(df, f"{self.root}/marts/run={run}/{mart}", "part")

    def write_parts(self, run: str, mart: str, manifest: list[Row]) -> None:
        rows = self.spark.createDataFrame(manifest, _PARTS).coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.root}/parts/run={run}/{mart}")

    def parts(self, run: str, mart: str) -> DataFrame:
        """``part, rows, digest, written_by`` of a fact as of a run, and the run's stamp."""
        return self._read(_PARTS, f"{self.root}/parts/run={run}/{mart}")

    def mart(self, run: str, mart: str) -> DataFrame:
        """A mart as the run built it, without load stamp. All rows of a fact get the stamp of the run, also
        those an earlier one wrote."""
        schema = StructType([f for f in MARTS[mart].fields if f.name != "etl_loaded_at"])
        parts = self.parts(run, mart).collect()  # one row a month
        if not parts:
            return self._read(schema, f"{self.root}/marts/run={run}/{mart}")
        rows = StructType([f for f in schema.fields if f.name != "dbt_run_started_at"])
        paths = [f"{self.root}/marts/run={p.written_by}/{mart}/part={p.part}" for p in parts]
        stamp = F.lit(parts[0].dbt_run_started_at.isoformat(sep=" ")).cast(TIMESTAMP).alias("dbt_run_started_at")
        return self.spark.read.schema(rows).parquet(*paths).select(*rows.names, stamp)

    def published(self) -> dict[str, DataFrame]:
        """The marts of the last run that passed, stamped with its load time."""
        last = self.last_commit()
        return {mart: with_loaded_at(self.mart(last.run, mart), last.loaded_at) for mart in MARTS}

    def create_views(self) -> None:
        """Views ``stg_<source>`` and one per mart, of the last run that passed, for ad hoc SQL."""
        last = self.last_commit()
        staged = {f"stg_{table}": self.staging(last.run, table) for table in SOURCES}
        for name, df in (staged | self.published()).items():
            df.createOrReplaceTempView(name)

    def remove_runs(self, before: datetime) -> list[str]:
        """Remove what only runs before a time need, and return the folders that went.

        Kept are the runs from then on and the last one that counts, with all they reach: parts of facts that
        earlier runs wrote, and the closed versions of every run that counts. Staging, open versions,
        dimensions, manifests and quarantine of other runs go, and all that runs which don't count have left.
        The raw zone, the audit copies and the log stay, so ``rebuild`` gives what it gave."""
        first, last = self.run_id(before), self.last_commit()
        counted = {row.run for row in self.log().select("run").collect()}  # names of runs, as in the folders
        stays = lambda run: run.removeprefix("rebuild_") >= first or bool(last and run == last.run)
        runs = {kind: self._folders(f"{self.root}/{kind}", "run=") for kind in ("staging", "marts", "parts", "quarantine")}
        reached = {
            (p.written_by, mart, p.part)
            for run in runs["parts"]
            if stays(run)
            for mart in self._folders(f"{self.root}/parts/run={run}")
            for p in self.parts(run, mart).select("written_by", "part").collect()
        }
        gone = [f"{kind}/run={run}" for kind in ("staging", "parts", "quarantine") for run in runs[kind] if not stays(run)]
        for run in runs["marts"]:
            for mart in self._folders(f"{self.root}/marts/run={run}") if not stays(run) else []:
                at = f"marts/run={run}/{mart}"
                parts = self._folders(f"{self.root}/{at}", "part=")
                lost = [p for p in parts if (run, mart, p) not in reached]
                gone += [at] if len(lost) == len(parts) else [f"{at}/part={p}" for p in lost]
        for table in self._folders(f"{self.root}/history"):
            for run in self._folders(f"{self.root}/history/{table}", "run="):
                at = f"history/{table}/run={run}"
                if run not in counted and not stays(run):
                    gone.append(at)
                elif not stays(run):
                    for buckets in self._folders(f"{self.root}/{at}", "buckets="):
                        gone += [f"{at}/buckets={buckets}/kept_as=open"] * ("open" in self._folders(f"{self.root}/{at}/buckets={buckets}", "kept_as="))
        for folder in gone:
            self._remove(f"{self.root}/{folder}")
        return gone

    def _folders(self, path: str, prefix: str = "") -> list[str]:
        """Names of the folders in a folder that begin with ``prefix``, without it."""
        target = self._path(path)
        files = target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = files.listStatus(target) if files.exists(target) else []
        names = [entry.getPath().getName() for entry in found if entry.isDirectory()]
        return sorted(name.removeprefix(prefix) for name in names if name.startswith(prefix))

    def quarantine(self, run: str, check: str, violations: DataFrame) -> None:
        violations.write.mode("overwrite").parquet(f"{self.root}/quarantine/run={run}/{check}")

    def _write(self, df: DataFrame, path: str, *by: str) -> int:
        seen, rows = counted(df)
        seen.write.mode("overwrite").partitionBy(*by).parquet(path)
        return rows()

    def _read(self, schema: StructType, path: str, **options: str) -> DataFrame:
        """Parquet at ``path``, or no rows where nothing was written."""
        try:
            return self.spark.read.schema(schema).options(**options).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
