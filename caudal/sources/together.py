"""Steps that do not read what another of them writes, run as concurrent jobs."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def together(work: list[Callable[[], object]]) -> list:
    """Results of the steps, in their order. All are run to their end; the first one that failed then raises its error."""
    if not work:
        return []
    with ThreadPoolExecutor(len(work)) as pool:
        return [future.result() for future in [pool.submit(step) for step in work]]
