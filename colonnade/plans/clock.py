"""Seconds that the steps of a plan take."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column
from pyspark.sql import functions as F

from colonnade.operators.catalog import TIMINGS


class Clock:
    """Adds up the seconds of named steps; a step ends with a written table, so its jobs are in its time.

    The files of a batch are described together: its times are those of the batch.
    """

    def __init__(self) -> None:
        self.started = time.perf_counter()
        self.seconds = dict.fromkeys(TIMINGS, 0.0)

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        """Time what runs inside; steps are not nested."""
        begin = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[name] += time.perf_counter() - begin

    def timings(self) -> Column:
        """All steps and the time since the start as one struct."""
        total = {"total_sec": time.perf_counter() - self.started}
        return F.struct(*[F.lit(seconds).alias(name) for name, seconds in (self.seconds | total).items()])
