"""Reading inputs, keeping intermediate tables where all executors see them, and shipping models."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martwright.llm import words

#: Bytes a model may have that is sent to every executor.
LARGEST_MODEL = 256 * 1024**2

#: Bytes of an Arrow batch, unless the session has a limit of its own.
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 * 1024**2


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a temporary folder, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Workspace:
    """Intermediate tables of one operator, as Parquet in the shared folder.

    A stored table cuts the lineage: what it took to make it isn't repeated when an executor is
    lost. ``drop`` removes a table no later step reads; the rest goes when the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
        self._paths: dict[int, tuple[DataFrame, str]] = {}
        self._files(self.folder, "deleteOnExit")

    def store(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(stored)] = stored, path
        return stored

    def drop(self, *stored: DataFrame) -> None:
        """Remove tables that ``store`` returned; others are left alone."""
        for df in stored:
            _, path = self._paths.pop(id(df), (None, None))
            if path:
                self._files(path, "delete", True)

    def _files(self, path: str, call: str, *args) -> None:
        context = self.spark.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        getattr(target.getFileSystem(context._jsc.hadoopConfiguration()), call)(target, *args)


def in_batches(df: DataFrame, run: Callable[[Iterator], Iterator], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` for tasks over texts, whose memory follows a few megabytes and not the partition.

    Spark's own limit, 10,000 rows or 64 MB, takes most partitions as one batch, which the executor and each worker
    hold whole, next to what is made from it. The limit is set for the session, as Spark has none for a single frame.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(words.released(run), schema)


def ship(spark: SparkSession, model: dict[str, bytes]) -> Broadcast:
    """A model whose size its parameters bound, to all executors."""
    size = sum(len(v) for v in model.values())
    if size > LARGEST_MODEL:
        raise ValueError(f"a model of {size} bytes is too large to send to every executor")
    return spark.sparkContext.broadcast(model)


def fold(key: Column | str) -> Column:
    """crc32 of the key as text, modulo 5; rows where it is 0, or the key NULL, teach nothing."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % 5


def held_out(key: str) -> Column:
    """Whether a document is kept from learning; one without an id is."""
    return F.coalesce(fold(key) == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """``text``, ``label`` of at most ``rows`` labelled documents outside the held-out fold.

    The labelled ids with the smallest hashes are taken, a choice that doesn't depend on how rows
    are partitioned. Ids with contradicting labels are left out; a document that occurs twice
    under one id is taken twice.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & ~held_out(key))
        .groupBy(F.col(key).alias("_id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("_most"))
        .filter(F.col("label") == F.col("_most"))
    )
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(rows).select("_id", "label")
    return docs.select(F.col(key).alias("_id"), "text").join(chosen, "_id").select("text", "label")


def fit_in_one_task(examples: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], dict[str, bytes]]) -> dict[str, bytes]:
    """Run ``fit`` over examples whose number a parameter of the sample bounds.

    Without any example Spark has no task to run, and ``fit`` makes the model of nothing here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = fit(batches)
        yield pa.RecordBatch.from_pydict({"name": list(model), "value": list(model.values())})

    fitted = examples.repartition(1).mapInArrow(words.released(run), "name string, value binary")
    return {name: bytes(value) for name, value in fitted.collect()} or fit(iter(()))


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def arrow_fields(df: DataFrame, more: str) -> StructType:
    """Columns of ``df`` and after them those of the DDL ``more``."""
    return StructType(df.schema.fields + StructType.fromDDL(more).fields)
