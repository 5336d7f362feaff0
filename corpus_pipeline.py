"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. Stages work on
everything that their predecessor kept. All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences. Null and
empty texts, repeated rows, extra columns and empty tables are treated as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.decontaminate import decontaminate
from candela.llm.jaccard import link_documents
from candela.llm.lines import dedup_lines
from candela.llm.packing import pack_documents
from candela.llm.quality import held_out, score, train
from candela.llm.queries import vocabulary
from candela.llm.ship import prepared
from candela.session import materialize, scratch_path
from candela.sources.tables import table

#: Ids that are broadcast to drop documents; more are joined.
BROADCAST_IDS = 500_000
#: Distinct page texts of a source that must have a line before it can be boilerplate.
LEAST_TEXTS = 5


def session(spark: SparkSession) -> SparkSession:
    """``spark`` with its settings; texts go to Python 250 rows at a time, not ten thousand (33 MB).

    Numpy's temporaries take about 60 bytes for each byte of a batch.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "250")
    return prepared(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of ``docs``, predicts as good."""
    labels = table(session(spark), sf_dir, "labels").filter(~held_out())
    scored = score(docs, train(docs, labels))
    return scored.filter("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their sources.

    Lines are counted over distinct texts, so that copies keep their text and
    are left to the near dedup.
    """
    session(spark)
    return dedup_lines(docs, least_texts=LEAST_TEXTS).select(*docs.columns)


def one_row_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row, an arbitrary one, for each doc_id (null is one) and text.

    Only the rows that repeat are shuffled with their texts.
    """
    row = F.struct("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"),
                   F.col("text").isNull().alias("no_text"))
    marked = docs.withColumn("__row", row)
    repeated = materialize(marked.groupBy("__row").count().filter("count > 1").select(
        F.col("__row").alias("__again")))
    n = repeated.count()
    if not n:
        return docs
    if n <= BROADCAST_IDS:
        repeated = F.broadcast(repeated)
    again = marked["__row"].eqNullSafe(F.col("__again"))
    once = marked.join(repeated, again, "left_anti")
    firsts = marked.join(repeated, again, "left_semi").dropDuplicates(["__row"])
    return materialize(once.unionByName(firsts).drop("__row"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of near copies.

    Rows of one id and text are one row; rows of one id with different texts are
    one document and stay or go together. A row without an id can't be a
    component's document: it links with nothing and stays, but once for each text.
    """
    session(spark)
    docs = one_row_each(docs)
    linked = link_documents(docs)
    gone = materialize(linked.filter("component_id != doc_id").select("doc_id").distinct())
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by benchmark items, also those without an id."""
    return decontaminate(docs, table(session(spark), sf_dir, "benchmark"), remove="documents", unnamed=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    session(spark)
    return (pack_documents(docs, vocabulary("byte_bpe_50k.json"))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", benchmark_decontamination), ("packing", packing)]

#: SQL has no classifier and no tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the last one's rows."""
    docs = table(session(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
