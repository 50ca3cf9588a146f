"""The corpus pipeline: five stages over documents, each written and read before the next.

Toxic documents go, then lines of later copies, then all but one of every group of
near copies, then documents that hold passages of the benchmark; what is left is
encoded with SentencePiece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart.llm import decontamination, lines, sentencepiece, simhash, toxicity
from ticketmart.llm.common import column, crc_remainder, materialise, table, unused

#: Where the public vocabulary lies.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a model of the labelled ones does not mark as toxic.

    A third of the labels is never learnt from, as in the query of the operator.
    """
    learnt = crc_remainder(F.col("doc_id"), 3) != 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), allowed=learnt)
    return toxicity.without_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 50 words or more that an earlier one has."""
    return lines.without_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose fingerprints link at two bits or fewer."""
    return simhash.without_near_duplicates(docs, distance=2, width=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without any window of a benchmark item."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their texts, and whether those decode to the text."""
    ids, same = unused(docs, "ids"), unused(docs, "round_trip")
    rows = sentencepiece.with_ids(docs, sentencepiece.read_model(MODEL), ids=ids, same=same)
    return rows.withColumn(unused(docs, "n_ids"), F.size(column(ids)))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: Fitting a classifier and merging pieces cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
