"""Corpus pipeline: five stages from raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder and hands it, reread, to
the next. Stages that change texts bring ``n_chars`` in line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from healthmart.llm.bag_minhash import near_classes
from healthmart.llm.common import cut, quoted, table
from healthmart.llm.line_chunks import dedup_lines
from healthmart.llm.packing import pack_rows
from healthmart.llm.pu_quality import score_quality, train
from healthmart.llm.suffix_dedup import remove_repeats


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one struct: no operator's own
    columns can take the place of an input column of the same name."""
    rest = [F.col(quoted(c)) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*rest).alias("carried"))


def _as_before(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, with n_chars of the text as it is now."""
    of = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        of["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[(of[c] if c in of else F.col("carried")[c]).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the positive-unlabelled classifier rejects."""
    model = train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return _unchanged(score_quality(_carried(docs), model).where("predicted = 1"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated chunks of lines; documents stay."""
    return _as_before(dedup_lines(_carried(docs)), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class stays."""
    return _unchanged(near_classes(_carried(docs)).where("kept"), docs)


def _unchanged(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[(F.col("text") if c == "text" else F.col("carried")[c]).alias(c) for c in docs.columns])


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages that also start earlier; documents stay."""
    return _as_before(remove_repeats(_carried(docs)), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences."""
    return pack_rows(docs.select("doc_id", "text"))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_copies), ("passages", passages), ("packing", packed)]

#: A trained classifier and near-duplicate classes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
