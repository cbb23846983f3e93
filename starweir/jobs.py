"""Independent Spark jobs that share the cluster instead of waiting in line."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

R = TypeVar("R")

JOBS_IN_FLIGHT = 6


def at_once(jobs: Iterable[Callable[[], R]], limit: int = JOBS_IN_FLIGHT) -> list[R]:
    """Run ``jobs``, at most ``limit`` at a time; their results in the given order.

    The first failure is raised once those already started have ended.
    """
    with ThreadPoolExecutor(limit) as pool:
        return [running.result() for running in [pool.submit(job) for job in jobs]]
