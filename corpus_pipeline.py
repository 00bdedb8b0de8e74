"""From raw documents to token ids: five stages, each on all that the one before kept.

Stages filter rows and keep the columns of ``documents``; the last returns what the
encoder made of the kept texts. Every stage is written as Parquet in the shared folder
and read again, so a lost executor costs no more than the stage it worked on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm import byte_bpe, decontaminate, jaccard_join, resample, toxicity
from panelforge.llm.common import table
from panelforge.session import reliable_checkpoint


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.5. NULL ids, empty texts and repeated rows are scored
    like any other; without labels nothing is dropped."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def draw_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows drawn by importance, as many as are good by the labelled texts among them.
    Repeated rows stay or go together; without good and bad ones nothing is dropped."""
    return resample.keep_drawn(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar texts: one with the smallest id. Rows with a NULL
    id stay only in groups without any id, one of each. Texts without words stay, all of
    them."""
    found = jaccard_join.jaccard_components(docs)
    return jaccard_join.keep_first(docs, found)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of a benchmark item. If a row without an id holds one,
    all rows without an id go, as they can't be told apart."""
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of ids and of the decoded bytes for each kept row. They are written here, so
    that few rows of whole texts at a time are on their way to the encoder."""
    return reliable_checkpoint(byte_bpe.digests(docs, *byte_bpe.public_vocabulary()), "ids", byte_bpe.BATCH_ROWS)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", draw_good),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_texts),
]

# Learned models and tokenization can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = reliable_checkpoint(stage(spark, docs, sf_dir), name)
    return docs
