"""From raw documents to packed sequences: quality, near duplicates, benchmark passages, personal data, packing.

Each stage takes all its predecessor kept and, but for the last, returns the columns of ``documents``. Every row is a document of
its own, whatever its id: near duplicates are numbered as they are read, so rows without words stay, all of them, and of linked
rows one does. A benchmark passage is looked up by a hash of id and text, which equal rows share. ``ORACLE_SQL`` is None: no stage but the joins could be said in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import decontamination, jaccard, packing, pii, quality
from tablesync.llm.queries import tokenizer_files
from tablesync.sources.staging import stage

__all__ = ["ORACLE_SQL", "STAGES", "run"]

ORACLE_SQL = None
GOOD = 0.7
BATCH_BYTES = "2m"  # of rows that go to a Python worker at once; Spark's own bound, 64 MB, is held by the executor, the worker and as Python objects

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(apply: Stage) -> Stage:
    """The stage with batches of ``BATCH_BYTES``, set for the session, as what a stage returns is computed later."""

    @wraps(apply)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return apply(spark, docs, sf_dir)

    return run


def _row_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.coalesce("text", F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_row_key().alias("doc_id"), "text")


def _with_key(docs: DataFrame) -> DataFrame:
    """The rows as one column beside their key, so that no column of theirs can clash with it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_key().alias("key"))


@_in_small_batches
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns as in the query of the operator."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = quality.learn_quality(docs.select("doc_id", "text"), labels.where(fold != 2).select("doc_id", "quality"))
    return quality.keep_good(docs, model, GOOD)


@_in_small_batches
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    # spread numbers: the hash of a long is a bijection, and the join of sets tells ids apart by their low bits
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.monotonically_increasing_id()).alias("key"))
    rows = stage(rows, "numbered").read()
    groups = jaccard.similar_components(rows.select(F.col("key").alias("doc_id"), "row.text"), width=5, percent=80)
    kept = stage(groups.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("key")), "kept").read()
    return rows.join(kept, "key", "left_semi").select("row.*")


@_in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontamination.find_passages(_keyed(docs), items).select(F.col("doc_id").alias("key")).distinct()
    return _with_key(docs).join(stage(found, "contaminated").read(), "key", "left_anti").select("row.*")


@_in_small_batches
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; ``n_chars`` follows."""
    out = pii.redact_texts(docs, pii.learn_pii(docs.select("doc_id", "text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    return packing.pack(packing.pieces(docs, *tokenizer_files()), capacity=1024)


STAGES = [
    ("quality", keep_good),
    ("near duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-")).read()
    return STAGES[-1][1](spark, docs, sf_dir)
