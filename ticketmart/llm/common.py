"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmart.config import scratch


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, which cuts its lineage.

    The files outlive the executors that wrote them, so a lost executor costs
    only its running tasks.
    """
    path = scratch(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Removes the files of a table that materialise() wrote and nothing reads any more."""
    context = frame.sparkSession.sparkContext
    for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def unused(frame: DataFrame, name: str) -> str:
    """A column name near the given one that the table does not have."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(name: str) -> Column:
    """Column of exactly that name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_text(
    frame: DataFrame,
    text: str,
    outputs: str,
    work: Callable[[list[str | None]], list[pa.Array]],
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds columns that Python computes from one text column, an Arrow batch at a time.

    `work` gets the texts of a batch and gives one array per output column, in
    the order of the schema string `outputs`. `keep` names the columns that stay;
    those that have the name of an output are replaced.
    """
    added = T._parse_datatype_string(outputs)
    fresh = {name.lower() for name in added.names}
    keep = [c for c in (frame.columns if keep is None else keep) if c.lower() not in fresh]
    holder = unused(frame, "_text_in")
    chosen = frame.select(*[column(name) for name in keep], column(text).alias(holder))
    schema = T.StructType([*chosen.schema.fields[:-1], *added.fields])
    names = [field.name for field in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            arrays = [batch.column(i) for i in range(last)]
            arrays += work(batch.column(last).to_pylist())
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return chosen.mapInArrow(run, schema)


def crc_remainder(key: Column, divisor: int) -> Column:
    """crc32 of a key written as text, by a divisor; null stays null."""
    return F.crc32(key.cast("string").cast("binary")) % divisor


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, limit: int
) -> DataFrame:
    """(doc_id, label, text) of at most `limit` labelled rows that may be learnt from.

    The rows with the smallest hashes of doc_id are taken, which does not depend
    on how the tables are divided. A document labelled twice counts as marked if
    any of its labels says so; of a repeated doc_id the least text is taken.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    texts = docs.select(column("doc_id").alias("doc_id"), column("text").alias("_text"))
    found = texts.join(known, "doc_id").filter(F.col("_text").isNotNull())
    return found.groupBy("doc_id", "_label").agg(F.min("_text").alias("_text"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stretches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equal whole-number keys together, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        edges = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            here = tuple(values[:, start])
            if held and here != name:
                yield pa.concat_batches(held) if len(held) > 1 else held[0]
                held = []
            name = here
            held.append(batch.slice(int(start), int(end - start)))
    if held:
        yield pa.concat_batches(held) if len(held) > 1 else held[0]
