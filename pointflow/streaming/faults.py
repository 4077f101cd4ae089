"""Faults at chosen places of the micro-batch loop, and restarts from the checkpoint.

A batch is delivered at least once: what was not committed comes again. Here a
run is ended on purpose, either between the items and the mark of a batch, so
that half of it is written, or after the mark and before Spark's commit, so that
a whole batch comes twice. The restarted query must end with the tables of a
clean pass.
"""

from __future__ import annotations

import threading
from collections.abc import Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame

from pointflow.streaming.distinct import BATCH_INTERVAL, BatchTables, run_batches

# between a batch's items and its mark, and between its mark and the commit
PLACES = ("items", "mark")


class InjectedFault(RuntimeError):
    """A fault that was asked for."""


class Faults:
    """Raises at each of the given `(place, batch)` once; counts what was raised and what was delivered."""

    def __init__(self, at: Iterable[tuple[str, int]]):
        self.left = set(at)
        if any(place not in PLACES for place, _ in self.left):
            raise ValueError(f"a place is one of {PLACES}")
        self.raised: list[tuple[str, int]] = []
        self.delivered: list[int] = []
        self._lock = threading.Lock()

    def __call__(self, place: str, number: int) -> None:
        with self._lock:
            if place == "items":
                self.delivered.append(number)
            if (place, number) not in self.left:
                return
            self.left.remove((place, number))
            self.raised.append((place, number))
        raise InjectedFault(f"{place} of batch {number}")


def run_through(
    stream: DataFrame,
    folder: str,
    faults: Faults,
    threshold: int | None = None,
    item: str = "item",
    interval: str | None = BATCH_INTERVAL,
) -> BatchTables:
    """`run_batches`, restarted from its checkpoint after every injected fault; other errors are not caught."""
    while True:
        raised = len(faults.raised)
        try:
            return run_batches(stream, folder, threshold, item, interval, hook=faults)
        except StreamingQueryException:
            if len(faults.raised) == raised:
                raise
