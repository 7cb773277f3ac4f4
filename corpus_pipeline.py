"""The stages that turn raw documents into training text; each works on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.byte_bpe import digests, encode_texts
from parcelledger.llm.common import stored, table
from parcelledger.llm.decontamination import find_leaks
from parcelledger.llm.exact_dedup import exact_dedup
from parcelledger.llm.jaccard_join import jaccard_join
from parcelledger.llm.toxicity import toxicity

#: Name of a row within a stage.
ROW = "stage_row"


def _named(docs: DataFrame) -> DataFrame:
    """The rows with a name each, as identifiers may be missing or repeated.

    A row of a file is named by the digest of the file's path and its place there, which stays however often it is read;
    nothing is copied for it. Rows that come from elsewhere are numbered and written, so that their numbers stay.
    """
    place = F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
    try:
        return docs.select("*", F.unhex(F.md5(place)).alias(ROW))
    except AnalysisException:
        return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")


def _by_row(rows: DataFrame) -> DataFrame:
    """Rows as an operator judges them: under their name in place of the identifier."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def _without(rows: DataFrame, judged: DataFrame) -> DataFrame:
    gone = judged.select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(gone, ROW, "left_anti").drop(ROW)


def _first_of(rows: DataFrame, judged: DataFrame, group: str, *order: Column) -> DataFrame:
    """Of the rows of each group the first by ``order``, then by identifier, those without one last."""
    place = F.struct(*order, F.col("doc_id").isNull(), F.col("doc_id"), F.col(ROW).alias("row"))
    groups = judged.select(F.col("doc_id").alias(ROW), F.col(group).alias("group"))
    best = rows.select(ROW, place.alias("place")).join(groups, ROW).groupBy("group").agg(F.min("place").alias("place"))
    return rows.join(best.select(F.col("place.row").alias(ROW)), ROW, "left_semi").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the network rejects go.

    Null and empty texts are judged as the network scores a window without words; equal texts get equal verdicts.
    """
    rows = _named(docs)
    judged = toxicity(_by_row(rows), table(spark, sf_dir, "labels"), fit_on=docs)
    return _without(rows, judged.filter("predicted = 1"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of equal texts one row stays, the longest; of these the smallest identifier, nulls last, then any one.

    All null, empty and white texts are equal, so one of them stays.
    """
    rows = _named(docs)
    return _first_of(rows, exact_dedup(_by_row(rows)), "keep_id", -F.char_length(F.coalesce("text", F.lit(""))))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of each group of near copies the smallest identifier stays, nulls last, of equal ones any one.

    Texts without words are near copies of nothing and stay.
    """
    rows = _named(docs)
    return _first_of(rows, jaccard_join(_by_row(rows)), "class_id")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that hold a benchmark passage go; null, empty and very short texts hold none and stay."""
    rows = _named(docs)
    return _without(rows, find_leaks(_by_row(rows), table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids of each text and what they decode to, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digests(encode_texts(docs, path, public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

#: No SQL states the trained network or the merges; the rows are tested against brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
