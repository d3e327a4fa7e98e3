"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from churnlens.llm import decontam, langid, lines, minmax, packing
from churnlens.llm.stages import staged
from churnlens.llm.tokens import public_vocabulary


#: Most bytes of a batch that goes to a Python worker. By rows alone a batch holds 10,000 whole texts,
#: of which executor and worker each keep copies in every running task.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of bounded bytes for what runs inside; the session's setting comes back after it."""
    before = spark.conf.get(_BATCH_SETTING)
    spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what is in no known language, or in none clearly; ``lang`` becomes the language found."""
    model = langid.train(docs, F.lit(True))
    found = langid.identify(docs.drop("lang_pred", "score", "ambiguous"), model).where("not ambiguous")
    return found.withColumn("lang", F.col("lang_pred")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines found in many documents, and documents of which nothing but white space is left.

    Near copies, by the rule of the next stage, count as one document for a line. So a group of
    them keeps its text, however large it is, and the next stage keeps one of them."""
    kept = lines.dedup_lines(docs, groups=minmax.near_duplicates(docs))
    gone = (F.col("n_dropped") > 0) & ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = kept.where(~gone)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near-duplicates, and one of rows that
    are repeated in full."""
    groups = minmax.near_duplicates(docs)
    dropped = groups.where("not kept").select(F.col("doc_id").alias("__id")).distinct()
    kept = docs.join(dropped, F.col("doc_id") == F.col("__id"), "left_anti")
    often = docs.groupBy(F.col("doc_id").alias("__id")).count().where("count > 1").drop("count")
    often = staged(often, "pipeline-repeated")
    if not often.isEmpty():
        same = F.col("doc_id").eqNullSafe(F.col("__id"))
        once = kept.join(often, same, "left_anti")
        kept = once.union(kept.join(often, same, "left_semi").dropDuplicates())
    return kept.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: a row per piece, with its ids."""
    return packing.pack(docs, public_vocabulary("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]

#: The language classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what its predecessor wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with small_batches(spark):
        for name, stage in STAGES[:-1]:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
