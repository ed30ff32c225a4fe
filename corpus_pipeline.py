"""The corpus pipeline: documents through a quality filter, line dedup, near
dedup and packing.  Every stage is written as Parquet and read again; all but
the last return the columns of ``documents``.

No SQL expresses the stages (a trained network, signatures, a tokenizer), so
``ORACLE_SQL`` is None and the stages are tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleflow.llm.byteconv import passing, train
from candleflow.llm.common import load
from candleflow.llm.linededup import dedup_lines
from candleflow.llm.minhash import near_duplicates, text_hashes
from candleflow.llm.packing import packed_digests
from candleflow.session import scratch_path

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network, trained on the labelled ones
    among them that aren't held out, scores 0.7 or more."""
    return passing(docs, train(docs, load(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages.  A document of which nothing but
    white space is left goes; n_chars follows the text.  The first place of a
    passage, by doc_id, stays; rows equal in doc_id and text keep or lose the
    same lines, null and empty texts stay as they are, an empty table too."""
    out = dedup_lines(docs)
    changed = F.col("removed_chunks") > 0
    left = out.where(~changed | (F.length(F.regexp_replace("text", r"\s+", "")) > 0))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the smallest doc_id's, of
    several texts under it the one with the smallest hash.  Rows are decided
    by doc_id and text, so a doc_id that stands on several texts loses only
    those that repeat others; rows equal in both are one, the smallest by its
    columns.  Rows without a doc_id stay, and so do texts without words.  An
    empty table stays empty."""
    decided = near_duplicates(docs, with_text=True).where("doc_id is not null and kept")
    best = decided.where("worded").groupBy("group_id").agg(F.min(F.struct("doc_id", "h1", "h2")).alias("b")).select("b.*")
    stay = best.unionByName(decided.where(~F.col("worded")).select("doc_id", "h1", "h2"))
    keys = [F.col("doc_id").cast("long").alias("d"), *text_hashes()]
    rows = docs.where("doc_id is not null").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *keys)
    one = rows.groupBy("d", "h1", "h2").agg(F.min("row").alias("row"))
    # Null and empty texts share their hashes; without words, every text of its own stays.
    worded = one.join(stay.withColumnRenamed("doc_id", "d"), ["d", "h1", "h2"], "left_semi").select("row.*")
    empty = docs.where("doc_id is not null and coalesce(text, '') = ''")
    return worded.where("coalesce(text, '') <> ''").unionByName(empty).unionByName(docs.where("doc_id is null"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, packed into sequences of 2048 tokens."""
    return packed_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; one row per packed piece."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
