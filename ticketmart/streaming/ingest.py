"""Ingest jobs as streams that take what has landed since the last run, then stop.

A micro-batch writes its own `batch_id=...` folder and overwrites it when it is
repeated after a failure, so every landed record has its effect once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmart import schemas, vocab
from ticketmart.config import exists, remove, scratch
from ticketmart.operators.dedupe import latest_per_key
from ticketmart.operators.joins import join_on, route
from ticketmart.plans import tickets as ticket_plan
from ticketmart.plans.current import keep_current
from ticketmart.plans.posts import Network, insight_snapshot, new_posts, undated_posts
from ticketmart.sinks.tables import split_required
from ticketmart.sources import tickets as landed

# writes rows as one output of the batch and gives them back as they were written
Store = Callable[[str, DataFrame], DataFrame]


def run_available(
    stream: DataFrame, job: Callable[[DataFrame, int, Store], object], folder: str
) -> None:
    """Runs the job over all input not seen by an earlier run with this folder."""

    def run(batch: DataFrame, batch_id: int) -> None:
        def store(name: str, rows: DataFrame) -> DataFrame:
            path = f"{folder}/{name}/batch_id={batch_id}"
            rows.write.mode("overwrite").parquet(path)
            return batch.sparkSession.read.parquet(path)

        job(batch, batch_id, store)

    query = (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", f"{folder}/_progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_output(
    spark: SparkSession, folder: str, name: str, evolving: bool = False
) -> DataFrame:
    """All batches of an output; of an evolving one, under the columns of all of them."""
    return spark.read.option("mergeSchema", evolving).parquet(f"{folder}/{name}")


def copy_available(stream: DataFrame, folder: str, name: str = "rows") -> DataFrame:
    """The rows of a stream as a table that every run extends."""
    run_available(stream, lambda batch, _, store: store(name, batch), folder)
    return read_output(stream.sparkSession, folder, name).drop("batch_id")


def not_seen(rows: DataFrame, known: DataFrame | None, keys: Sequence[str], time: str) -> DataFrame:
    """Rows whose keys no earlier batch has stored, each once.

    Only the known keys between the least and the largest time of the rows are
    read, as a repeated row has the time it had before.
    """
    fresh = rows.dropDuplicates([*keys])
    if known is None:
        return fresh
    least, largest = rows.agg(F.min(time), F.max(time)).first()
    if least is None:
        return fresh
    near = known.where(F.col(time).between(least, largest)).select(*keys)
    return join_on(fresh, near, keys, "left_anti")


def ingest_tickets(
    spark: SparkSession,
    landing: str,
    folder: str,
    year: int,
    start: float,
    end: float,
    current: str | None = None,
) -> None:
    """Raw orders, and wide rows per ticket group, from newly landed attendees.

    An attendee is judged by the year and interval of the run in which it landed.
    Those asked for whose event has not landed wait under their own run, and every
    later batch tries them again, also one that only events have started; those
    that no load can take are stored as rejected with the reason, and orders that
    no wide table can take as wide_rejected. An order that lands again, equal to
    one that a batch has stored, is not stored again. With a prefix `current`, the
    latest row per event and registration number is kept in `<current>_<group>`.
    """

    def job(replies: DataFrame, batch_id: int, store: Store) -> None:
        batch = replies.where("kind = 'attendees'").drop("kind")
        events = landed.read_events(spark, landing)
        if batch_id:
            earlier = read_output(spark, folder, "waiting")
            earlier = earlier.where(F.col("batch_id") == batch_id - 1).drop("batch_id")
            batch = batch.unionByName(earlier, allowMissingColumns=True)
        batch = ticket_plan.under_run(batch, year, start, end)
        # landed replies are read once; the steps below read those they can have a use for
        held_batch = scratch(spark, "batch")
        ticket_plan.of_concern(batch).write.parquet(held_batch)
        batch = spark.read.schema(batch.schema).parquet(held_batch)
        rejected, waiting = ticket_plan.sort_out(events, batch)
        store("rejected", rejected.drop(*ticket_plan.RUN))
        store("waiting", ticket_plan.asked_for(waiting).distinct())
        held = scratch(spark, "chosen")
        orders = ticket_plan.order_rows(ticket_plan.selected_by_run(events, batch))
        orders.withColumns(
            {
                "digest": F.sha2("attendee_info", 256),
                "updated_at": F.get_json_object("attendee_info", "$.updated_at").cast("double"),
            }
        ).write.parquet(held)
        known = None
        if batch_id and exists(spark, f"{folder}/stored"):
            known = read_output(spark, folder, "stored").where(F.col("batch_id") < batch_id)
        chosen = spark.read.parquet(held)
        fresh = not_seen(chosen, known, ["id", "digest"], "updated_at")
        stored = store("orders", fresh.drop("digest", "updated_at"))
        store("stored", chosen.select("id", "digest", "updated_at").distinct())
        remove(spark, held)
        remove(spark, held_batch)
        store("wide_rejected", ticket_plan.wide_rejects(stored))
        routed = route(stored, F.col("name"), vocab.TICKET_GROUPS)
        for group in vocab.TICKET_GROUPS:
            of_group = routed.where(F.col("ticket_group") == group)
            if not of_group.isEmpty():
                wide = ticket_plan.wide_rows(of_group, events=True, odd=True)
                rows = store(f"wide_{group}", wide)
                if current:
                    keep_current(spark, rows, f"{current}_{group}")

    # one source for both, so that progress of runs that read attendees alone stays valid
    replies = spark.readStream.schema(landed.ATTENDEES).json(f"{landing}/{{attendees,events}}")
    kind = F.regexp_extract("_metadata.file_path", ".*/(attendees|events)/", 1)
    run_available(replies.withColumn("kind", kind), job, folder)


def ingest_posts(
    network: Network,
    replies: DataFrame,
    folder: str,
    as_of: datetime | str | None = None,
    read: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """New posts, and counters of all posts, from newly landed replies.

    `read` takes the place of the network's reader where that needs a second
    input.
    """
    spark = replies.sparkSession

    def job(batch: DataFrame, batch_id: int, store: Store) -> None:
        posts, aside = split_required((read or network.read)(batch), schemas.POSTS)
        store("undated", undated_posts(aside, as_of))
        if batch_id == 0:
            known = spark.createDataFrame([], schemas.POSTS)
        else:
            earlier = read_output(spark, folder, "posts")
            known = earlier.where(F.col("batch_id") < batch_id)
        fresh = new_posts(posts, known)
        store("posts", latest_per_key(fresh, ["id"], [F.desc("created_at"), F.desc("message")]))
        store("insights", insight_snapshot(posts, as_of, network.insights))

    run_available(replies, job, folder)
