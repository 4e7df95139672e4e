"""Small helpers over several frames or tables at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: Independent jobs that may run side by side, to fill a cluster while one drains.
PARALLEL_JOBS = 8

T, R = TypeVar("T"), TypeVar("R")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union of many frames, pair by pair, so that the plan isn't analysed anew for each."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [pair[0].unionAll(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return frames[0]


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """``df``, and a function that says how many rows of it the first action, a write, has seen."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get.get("rows", 0)


def for_each(items: Iterable[T], job: Callable[[T], R]) -> list[R]:
    """Run a job per item, several at a time; the first failure is raised."""
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        return list(pool.map(job, items))
