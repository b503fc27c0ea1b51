"""Per-row calls to an outside service, with retries, inside Spark tasks."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def call_with_retry(
    call: Callable[[int], str],
    key: int,
    attempts: int = 3,
    base: float = 0.1,
    cap: float = 2.0,
    jitter: float = 0.1,
    retry_on: tuple[type[BaseException], ...] = (Exception,),
    sleep: Callable[[float], None] = time.sleep,
) -> tuple[str | None, int, str | None]:
    """(result, attempts used, error). Only ``retry_on`` is tried again; other errors are raised.

    The wait doubles from ``base`` up to ``cap``, plus up to ``jitter`` seconds at random.
    """
    error = None
    for used in range(1, attempts + 1):
        try:
            return call(key), used, None
        except retry_on as exc:
            error = f"{type(exc).__name__}: {exc}"
            if used < attempts:
                sleep(min(cap, base * 2 ** (used - 1)) + random.uniform(0, jitter))
    return None, attempts, error


def enriched(df: DataFrame, key: str, make_call: Callable[[], Callable[[int], str]], **retry) -> DataFrame:
    """(id, result, attempts, error) for each row of ``df``; exhausted rows carry their error.

    ``make_call`` runs once per task and returns the client function. A slow service limits one
    task, not the job: spread the keys over more partitions for more calls at a time.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make_call()
        for batch in batches:
            out = [call_with_retry(call, k, **retry) for k in batch[key]]
            yield pd.DataFrame(
                {
                    "id": batch[key],
                    "result": [r for r, _, _ in out],
                    "attempts": [n for _, n, _ in out],
                    "error": [e for _, _, e in out],
                }
            )

    schema = "id BIGINT, result STRING, attempts INT, error STRING"
    return df.select(key).mapInPandas(work, schema)
