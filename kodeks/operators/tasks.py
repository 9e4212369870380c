"""Row tasks with retry and a dead-letter status."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Work = Callable[[dict, int], str]


def run_rows(df: DataFrame, key: str, work: Work, retries: int = 3, delay: float = 5.0, growth: float = 1.0) -> DataFrame:
    """(key, status, attempts, result, error) of ``work(row, attempt)`` for every row. A row whose last attempt raises is
    ``failed`` with its error and stops no other row; lost tasks are Spark's own to repeat. ``delay`` seconds lie before
    the second attempt, and ``growth`` times as many before each later one."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                for attempt in range(1, retries + 1):
                    try:
                        out.append((row[key], "success", attempt, str(work(row, attempt)), None))
                        break
                    except Exception as e:  # noqa: BLE001
                        if attempt == retries:
                            out.append((row[key], "failed", attempt, None, f"{type(e).__name__}: {e}"))
                        elif delay:
                            time.sleep(delay * growth ** (attempt - 1))
            yield pd.DataFrame(out, columns=[key, "status", "attempts", "result", "error"])

    return df.mapInPandas(run, f"{key} {kind}, status string, attempts int, result string, error string")


def rerun_failed(df: DataFrame, results: DataFrame, key: str, work: Work, **how) -> DataFrame:
    """Results of ``run_rows`` with the rows that failed run again."""
    failed = results.where("status = 'failed'").select(key)
    return results.where("status <> 'failed'").unionByName(run_rows(df.join(failed, key, "left_semi"), key, work, **how))


class Pipeline:
    """Steps run in order, each with the result of the one before.

    A step is repeated up to ``retries`` times. Its result (a path, a number, a small value) is kept by the hash of its
    name and input in ``cache``, so a run that is started again goes on where it failed. If a step fails for good, what
    the steps before registered as ``undo`` is called in reverse order, unless their results were cached. Times are kept
    in ``seconds``.
    """

    def __init__(self, cache: dict | None = None) -> None:
        self.steps: list[tuple[str, Callable, Callable | None, int, float]] = []
        self.cache = {} if cache is None else cache
        self.seconds: dict[str, float] = {}

    def step(self, name: str, run: Callable, undo: Callable | None = None, retries: int = 1, delay: float = 0.0) -> Pipeline:
        self.steps.append((name, run, undo, retries, delay))
        return self

    def run(self, value: object = None) -> object:
        done: list[tuple[Callable | None, object]] = []
        for name, run, undo, retries, delay in self.steps:
            at = hashlib.sha256(json.dumps([name, value], sort_keys=True, default=str).encode()).hexdigest()
            if at in self.cache:
                value = self.cache[at]
                continue
            began = time.time()
            for attempt in range(1, retries + 1):
                try:
                    value = run(value)
                    break
                except Exception:
                    if attempt == retries:
                        for back, result in reversed(done):
                            if back:
                                back(result)
                        raise
                    time.sleep(delay)
            self.seconds[name] = time.time() - began
            self.cache[at] = value
            done.append((undo, value))
        return value
