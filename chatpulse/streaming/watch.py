"""What running queries report: progress, silence and failure."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass(frozen=True)
class Seen:
    """What a query last reported; ``at`` is when, by the watch's clock."""

    name: str
    at: float
    triggers: int = 0
    rows: int = 0
    late: int = 0
    state_rows: int = 0
    watermark: str | None = None
    failure: str | None = None
    is_over: bool = False


class StalledQuery(RuntimeError):
    """A query that is active and reports nothing."""


class Watch(StreamingQueryListener):
    """Listens to all queries of a session.

    An idle query reports that it is idle, so one that reports nothing for long
    hangs in its source, its state or its sink. Counts are of this process only: a
    restarted query starts at 0 here.
    """

    def __init__(self, clock: Callable[[], float] = time.monotonic):
        self._clock, self._lock = clock, threading.Lock()
        self._seen: dict[str, Seen] = {}

    def __enter__(self) -> Watch:
        return self

    def attach(self, spark: SparkSession) -> Watch:
        spark.streams.addListener(self)
        self._spark = spark
        return self

    def __exit__(self, *failure) -> None:
        self._spark.streams.removeListener(self)

    def _update(self, run: object, **changes) -> None:
        with self._lock:
            old = self._seen.get(str(run)) or Seen(name=str(run), at=0.0)
            self._seen[str(run)] = Seen(**{**vars(old), **changes, "at": self._clock()})

    def onQueryStarted(self, event) -> None:
        self._update(event.runId, name=event.name or str(event.id))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            old = self._seen.get(str(progress.runId))
        states = progress.stateOperators
        self._update(
            progress.runId,
            triggers=(old.triggers if old else 0) + 1,
            rows=(old.rows if old else 0) + progress.numInputRows,
            late=(old.late if old else 0) + sum(s.numRowsDroppedByWatermark for s in states),
            state_rows=sum(s.numRowsTotal for s in states),
            watermark=(progress.eventTime or {}).get("watermark"),
        )

    def onQueryIdle(self, event) -> None:
        self._update(event.runId)

    def onQueryTerminated(self, event) -> None:
        self._update(event.runId, is_over=True, failure=event.exception)

    def seen(self) -> dict[str, Seen]:
        """The last report of every run, by its id."""
        with self._lock:
            return dict(self._seen)

    def expect(self, queries: Iterable[StreamingQuery]) -> None:
        """Counts the silence of queries that run already from now on."""
        for query in queries:
            self._update(query.runId, name=query.name or str(query.id))

    def stalled(self, seconds: float) -> dict[str, Seen]:
        """Active runs that reported nothing for so long."""
        now = self._clock()
        return {run: s for run, s in self.seen().items() if not s.is_over and now - s.at > seconds}

    def failures(self) -> list[Seen]:
        return [s for s in self.seen().values() if s.failure is not None]

    def report(self) -> str:
        """One JSON line a run, for a job's log."""
        return "\n".join(json.dumps({**vars(s), "at": round(s.at, 3)}) for s in self.seen().values())
