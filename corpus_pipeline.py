"""Documents to packed sequences: the stages in order, each written and read again.

1. ``quality``: documents that the neighbours' votes reject go.
2. ``near_duplicates``: of documents similar by five-word shingles (0.8 or more) one stays, the smallest id.
3. ``repeats``: passages of 13 words or more that an earlier document holds go from the later ones.
4. ``mix``: sources are used to their target weights; a document may come twice, one per source is cut.
5. ``pack``: token pieces with their places in sequences of 4096.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm.jaccard import one_of_each
from shoal.llm.language import crc_mod
from shoal.llm.mixing import mix
from shoal.llm.packing import pack, pieces
from shoal.llm.quality import accepted
from shoal.llm.queries import table, vocabulary
from shoal.llm.repeats import without_repeats
from shoal.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose nearest labelled neighbours vote for them; labels are learnt from the rows that aren't held out.

    Null and empty texts, rows without an id and repeated rows are judged like any other. An empty table gives no rows.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    return accepted(docs, labels, crc_mod(F.col("doc_id"), 5) != 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id. Rows without an id or words stay; rows that share an
    id stay together."""
    return one_of_each(docs, per_cent=80, k=5)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that one with a smaller id holds.

    A document that is left without words stays, as every row that comes in goes out: it's mixed once and packed as its end id
    alone. Rows without an id keep their text and take none from others.
    """
    return without_repeats(docs, window=13)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once for each time it is used. Texts without words are kept once; a null source is one of its own."""
    return mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset; null texts are empty and hold the end id alone."""
    return pack(pieces(docs, vocabulary("word_bpe_49k.json"), end_id=1, cap=4096), 4096)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats), ("mix", mixture), ("pack", packed)]

#: The first stage learns a model, which SQL can't express; tests/llm/test_pipeline.py compares every stage with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
