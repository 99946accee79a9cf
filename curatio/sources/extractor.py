"""The seam for extraction by a language model or any other service: partitions in, classified results out.

The service itself is not part of this repository; ``extracted`` takes any function of a batch.  What comes back
is classified here: parsed, truncated, unparseable, or failed after retries.  Results are tables, so a run can be
taken up again by what is still pending.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.text import truncated


class Transient(Exception):
    """A rate limit or passing fault: tried again."""


class Fatal(Exception):
    """Bad credentials: nothing more is tried."""


@dataclass(frozen=True)
class Retry:
    """How often and how long."""

    tries: int = 5
    base_seconds: float = 2.0
    jitter_seconds: float = 1.0


def with_retries(call: Callable[[str], str], prompt: str, retry: Retry = Retry(), sleep: Callable[[float], None] = time.sleep) -> tuple[str, str]:
    """(status, text): succeeded, or failed after the last try; a fatal fault goes through."""
    for n in range(retry.tries):
        try:
            return "succeeded", call(prompt)
        except Transient as e:
            if n + 1 == retry.tries:
                return "failed", str(e)
            sleep(retry.base_seconds * 2**n + random.uniform(0, retry.jitter_seconds))
        except ValueError as e:
            return "failed", str(e)
    return "failed", ""


def extracted(prompts: DataFrame, call: Callable[[str], str], key: str = "page_id", prompt: str = "prompt", retry: Retry = Retry(), abort_after: int = 3) -> DataFrame:
    """(key, status, text) for each prompt; after ``abort_after`` failures in a row a partition's rest is 'skipped'."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed = 0
        for b in batches:
            out = []
            for k, p in zip(b["key"], b["prompt"], strict=True):
                status, text = ("skipped", "") if failed >= abort_after else with_retries(call, p, retry)
                failed = failed + 1 if status == "failed" else 0 if status == "succeeded" else failed
                out.append((k, status, text))
            yield pd.DataFrame(out, columns=["key", "status", "text"])

    kind = dict(prompts.dtypes)[key]
    rows = prompts.select(F.col(key).alias("key"), F.col(prompt).alias("prompt"))
    return rows.mapInPandas(work, f"key {kind}, status string, text string").withColumnRenamed("key", key)


def json_array(text: Column) -> Column:
    """The JSON list in an answer: fenced, bare, or a single object wrapped in a list; null if there is none."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = F.trim(F.when(fenced != "", fenced).otherwise(text))
    listed, single = F.regexp_extract(body, r"(?s)(\[.*\])", 1), F.regexp_extract(body, r"(?s)(\{.*\})", 1)
    wrapped = F.concat(F.lit("["), single, F.lit("]"))
    found = F.when(body.startswith("["), listed).when(single != "", wrapped).when(listed != "", listed)
    return F.when(F.try_parse_json(found).isNotNull(), found)


def classified(results: DataFrame, text: str = "text", status: str = "status", stop: str = "stop_reason") -> DataFrame:
    """Adds ``outcome``: parsed, errored (a service fault or a truncated answer), unparseable, expired or canceled."""
    outcome = (
        F.when(F.col(status).isin("expired", "canceled"), F.col(status))
        .when((F.col(status) != "succeeded") | (F.coalesce(F.col(stop), F.lit("")) == "max_tokens"), "errored")
        .when(json_array(F.col(text)).isNull(), "unparseable")
        .otherwise("parsed")
    )
    return results.withColumn("outcome", outcome).withColumn("entities_json", json_array(F.col(text)))


def prompt_for(page: Column, entity_type: Column, instructions: Column) -> Column:
    return F.concat(instructions, F.lit("\n\nEntity type: "), entity_type, F.lit("\n\n"), page)


def short_source(source: Column) -> Column:
    return truncated(source, 80)
