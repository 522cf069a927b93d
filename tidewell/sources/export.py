"""Export of serving rows to a key-value store in bounded batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A store client: takes rows as dicts, gives back those it did not process.
Put = Callable[[list[dict]], Sequence[dict]]


class NotStored(RuntimeError):
    """The store did not take all rows of a task."""


def export_rows(
    df: DataFrame,
    open_store: Callable[[], Put],
    batch_rows: int = 25,
    attempts: int = 15,
    pause_seconds: float = 0.05,
    longest_pause: float = 5.0,
) -> DataFrame:
    """Send every row; rows the store leaves unprocessed are sent again with a growing pause.

    Gives one row: rows sent, batches and retries.  A row that is still not stored after ``attempts`` fails its task,
    so a finished export has stored everything.  ``open_store`` runs once per task.  Puts must be by key: a task
    that is run again sends the same rows again.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        put = open_store()
        sent = count = retries = 0
        for frame in batches:
            rows = frame.to_dict("records")
            for start in range(0, len(rows), batch_rows):
                pending, pause = rows[start : start + batch_rows], pause_seconds
                size, count = len(pending), count + 1
                for attempt in range(attempts):
                    if attempt:
                        retries += 1
                        time.sleep(pause)
                        pause = min(pause * 2, longest_pause)
                    pending = list(put(pending))
                    if not pending:
                        break
                if pending:
                    raise NotStored(f"{len(pending)} of {size} rows not stored after {attempts} attempts, the first of them {pending[0]}")
                sent += size
        yield pd.DataFrame({"rows": [sent], "batches": [count], "retries": [retries]})

    per_task = df.mapInPandas(send, "rows bigint, batches bigint, retries bigint")
    return per_task.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "batches", "retries")])


def file_store(folder: str) -> Callable[[], Put]:
    """A store made of JSON-line files in a shared folder, for trials without a store."""

    def open_store() -> Put:
        import json
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        path = os.path.join(folder, uuid.uuid4().hex + ".jsonl")

        def put(rows: list[dict]) -> list[dict]:
            with open(path, "a", encoding="utf-8") as handle:
                for row in rows:
                    handle.write(json.dumps(row, default=str) + "\n")
            return []

        return put

    return open_store
