"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

All stages but the last keep the columns of ``documents``. Without documents every stage gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import decontamination, jaccard_join, packing, substring_dedup, tables, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    params = toxicity.ToxicityParams()
    scored = toxicity.score(docs, toxicity.train(docs, tables.read(spark, sf_dir, "labels"), params), params)
    name = scored.columns[-1]
    return scored.filter(F.col(f"{name}.score") < params.threshold).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id, of each group that links of near copies join."""
    return jaccard_join.first_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without stretches and lines that an earlier place has; ``n_chars`` follows."""
    cut = substring_dedup.remove_repeats(docs, substring_dedup.DedupParams(least_line_words=3))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    found = decontamination.find_leaks(docs, tables.read(spark, sf_dir, "benchmark"))
    name = found.columns[-1]
    return found.filter(F.size(name) == 0).drop(name)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack),
]

#: The stages learn models and run tokenizers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is kept in the shared folder for the next."""
    work = tables.Workspace(spark)
    docs = tables.read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        kept = work.store(stage(spark, docs, sf_dir))
        work.drop(docs)
        docs = kept
    return docs
