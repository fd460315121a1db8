"""Progress of running imports: throttled key=value records, and retries of contended steps."""

from __future__ import annotations

import logging
import random
import sys
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import TypeVar

from .ledger import progress

T = TypeVar("T")
log = logging.getLogger("groovemill.progress")
STATES = ("started", "running", "completed", "failed", "observation_error")


@dataclass
class Reporter:
    """Reports an entity's progress at its start and end and every `every` seconds in between.

    `observe` returns (done, total); an error in it is reported and never stops the import. Without a sink, records go to
    the log unless someone watches a terminal."""

    entity: str
    observe: Callable[[], tuple[int, int | None]]
    sink: Callable[[dict], None] | None = None
    every: float = 5.0
    clock: Callable[[], float] = time.monotonic
    began: float = field(default=0.0, init=False)
    due: float = field(default=0.0, init=False)

    def _put(self, state: str) -> None:
        now = self.clock()
        try:
            done, total = self.observe()
            record = {"entity": self.entity, "state": state, "done": done, "total": total, **progress(done, total, now - self.began)}
        except Exception as e:
            record = {"entity": self.entity, "state": "observation_error", "error": f"{type(e).__name__}: {e}"}
        self.due = now + self.every
        if self.sink:
            self.sink(record)
        elif not sys.stderr.isatty():
            log.info(" ".join(f"{k}={v}" for k, v in record.items()))

    def start(self) -> None:
        self.began = self.clock()
        self._put("started")

    def report_if_due(self) -> bool:
        if self.clock() < self.due:
            return False
        self._put("running")
        return True

    def finish(self, ok: bool) -> None:
        self._put("completed" if ok else "failed")


def retrying(step: Callable[[], T], errors: tuple[type[Exception], ...], retries: int = 5, first: float = 0.1, factor: float = 2.0, jitter: float = 0.05, most: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """The step's result, tried again after the given errors with growing pauses."""
    pause = first
    for _ in range(retries):
        try:
            return step()
        except errors:
            sleep(min(most, max(0.0, pause + random.uniform(-jitter, jitter))))
            pause = min(most, pause * factor)
    return step()
