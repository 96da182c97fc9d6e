"""Stages that ask an outside service: pluggable, retried, resumable, and faked in tests."""

import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Client(Protocol):
    """Answers one request; raises or returns an empty text on failure."""

    def complete(self, prompt: str) -> str: ...


def ask(client: Client, prompt: str, tries: int = 3, wait: tuple[float, float] = (2, 5), busy_wait: tuple[float, float] = (5, 15), is_busy: Callable[[Exception], bool] = lambda e: False, accepts: Callable[[str], bool] = bool, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None]:
    """(answer, None), or (None, error) after `tries` attempts; waits grow with the attempt, longer when it is busy.

    An answer that `accepts` refuses (by default an empty one) is asked for again, like a failure.
    """
    error = "empty answer"
    for n in range(1, tries + 1):
        low, high = wait
        try:
            answer = client.complete(prompt)
            if answer and accepts(answer):
                return answer, None
            error = "answer not accepted" if answer else "empty answer"
        except Exception as e:  # noqa: BLE001  a service may raise anything
            error = f"{type(e).__name__}: {e}"
            low, high = busy_wait if is_busy(e) else wait
        if n < tries:
            sleep(random.uniform(low, high) * n)
    return None, f"failed after {tries} tries: {error}"


def external_stage(rows: DataFrame, make_client: Callable[[], Client], key: str, prompt_col: str, answer_col: str = "response", concurrency: int = 16, **how) -> DataFrame:
    """(key, answer, ok, error) of every row. A partition makes one client and keeps `concurrency` requests in flight.

    how: what `ask` takes besides (tries, wait, busy_wait, is_busy, accepts, sleep).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        with ThreadPoolExecutor(concurrency) as pool:
            for pdf in batches:
                got = list(pool.map(lambda p: ask(client, p or "", **how), pdf[prompt_col]))
                yield pd.DataFrame({key: pdf[key], answer_col: [a for a, _ in got], "ok": [e is None for _, e in got], "error": [e for _, e in got]})

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, prompt_col).mapInPandas(run, f"{key} {kind}, {answer_col} string, ok boolean, error string")
