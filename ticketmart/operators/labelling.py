"""Labelling of free-text values in batches through a pluggable labeller."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmart.operators import joins
from ticketmart.operators.numbering import number_in_order
from ticketmart.operators.payload import parse_reply
from ticketmart.vocab import INDUSTRIES, JOB_CLASSES

Labeller = Callable[[str, list[str]], "str | None"]

_TASKS = {
    "organization": ("公司/組織名稱", "產業類別", INDUSTRIES),
    "job_title": ("職位名稱", "職位類別", JOB_CLASSES),
}


def task_text(task: str) -> str:
    """Instruction for one labelling task, with its table of categories."""
    if task not in _TASKS:
        raise ValueError(f"不支援的工作類型: {task} (organization, job_title)")
    subject, kind, categories = _TASKS[task]
    table = "\n".join(f"{number},{label}" for number, label in categories.items())
    return (
        f"請為每一筆{subject}標記{kind}，無法判斷時給 0。\n\n"
        f"{kind}對照表:\n{table}\n\n"
        f'請只輸出 json: [{{"{task}": "{subject}", "category": "類別編號"}}]'
    )


def chunk(values: DataFrame, column: str, size: int) -> DataFrame:
    """Distinct values with the number of their batch; every batch is full but the last."""
    return number_in_order(values.select(column).distinct(), [column]).select(
        F.expr(f"start div {int(size)}").alias("batch"), column
    )


def _json_list(values: Column) -> Column:
    quoted = F.transform(
        values, lambda value: F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")
    )
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def batch_prompts(chunks: DataFrame, column: str, task: str, token_limit: int) -> DataFrame:
    """One prompt per batch, flagged if its list nears the limit. A batch is of bounded size."""
    batches = chunks.groupBy("batch").agg(F.array_sort(F.collect_list(column)).alias("items"))
    listed = batches.withColumn("_list", _json_list(F.col("items")))
    return listed.select(
        "batch",
        "items",
        F.concat(F.lit(f"{task_text(task)}\n資料列表:\n"), "_list").alias("prompt"),
        (F.char_length("_list") > token_limit * 0.8).alias("near_limit"),
    )


def ask(prompts: DataFrame, labeller: Labeller, parallel: int | None = None) -> DataFrame:
    """Reply per batch; a batch whose call fails gets the error instead, others go on.

    `parallel` sets over how many tasks the batches are spread: prompts are
    small, so by their size alone few tasks would make all the calls.
    """
    if parallel:
        prompts = prompts.repartition(parallel, "batch")

    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = []
            for batch, prompt, items in zip(frame["batch"], frame["prompt"], frame["items"]):
                try:
                    answers.append((batch, labeller(prompt, list(items)), None))
                except Exception as error:  # noqa: BLE001 - any failure of a service call
                    answers.append((batch, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(answers, columns=["batch", "reply", "error"])

    return prompts.select("batch", "prompt", "items").mapInPandas(
        call, "batch bigint, reply string, error string"
    )


def labels(replies: DataFrame, task: str) -> DataFrame:
    """Labelled values; a category that is no number fails the job."""
    rows = replies.where(F.col("error").isNull()).select(
        F.explode(parse_reply(F.col("reply"), task)).alias("row")
    )
    return rows.select(
        F.col("row")[task].alias(task), F.col("row.category").cast("long").alias("category")
    )


def failed_batches(replies: DataFrame, task: str) -> DataFrame:
    """Batches that gave no labels: the call failed, or the reply is empty or cannot be read."""
    empty = F.coalesce(F.trim("reply"), F.lit("")) == ""
    unread = parse_reply(F.col("reply"), task).isNull()
    why = F.when(empty, F.lit("empty reply")).when(unread, F.lit("unreadable reply"))
    return replies.select(
        "batch",
        F.coalesce("error", why).alias("error"),
        "reply",
    ).where(F.col("error").isNotNull())


def unlabelled(prompts: DataFrame, labelled: DataFrame, failed: DataFrame, task: str) -> DataFrame:
    """(batch, value) of all values asked for that readable replies leave out."""
    asked = prompts.select("batch", F.explode("items").alias(task))
    answered = joins.join_on(asked, failed.select("batch"), ["batch"], "left_anti")
    return joins.join_on(answered, labelled.select(task).distinct(), [task], "left_anti")


def keyword_category(text: Column, keywords: Sequence[tuple[str, int]]) -> Column:
    """Category of the first keyword found in the text, 0 if none is."""
    category = F.lit(0)
    for word, number in reversed(list(keywords)):
        category = F.when(F.contains(F.lower(text), F.lit(word.lower())), number).otherwise(
            category
        )
    return category


def keyword_labeller(task: str, keywords: Sequence[tuple[str, int]]) -> Labeller:
    """Labeller that needs no service: replies in the form of one, from a keyword list."""
    words = [(word.lower(), number) for word, number in keywords]

    def reply(_: str, items: list[str]) -> str:
        import json

        rows = [
            {task: item, "category": str(next((n for w, n in words if w in item.lower()), 0))}
            for item in items
        ]
        return "```json" + json.dumps(rows, ensure_ascii=False) + "```"

    return reply
