"""Starting and supervising streaming queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import (
    DataStreamWriter,
    StreamingQuery,
    StreamingQueryException,
)

from chatpulse.streaming.watch import Seen, StalledQuery, Watch


def start(
    writer: DataStreamWriter,
    output_mode: str,
    checkpoint: str,
    *,
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Starts a query: as fast as it can, ``every`` interval, or over what is there."""
    writer = writer.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def finish(*queries: StreamingQuery) -> None:
    """Waits for available-now queries; if one fails, stops the others and raises its error."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark and were not counted.

    Spark counts them behind the partial aggregate: several messages of one key
    in one task are one row. 0 says that no message was late.
    """
    return sum(
        state.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for state in progress.stateOperators
    )


def supervise(
    spark: SparkSession,
    queries: Sequence[StreamingQuery],
    stall_seconds: float | None = None,
) -> Watch:
    """Waits until any query ends, stops the rest, and raises if one failed.

    A speed layer with one dead query would go on showing stale numbers, so the
    job ends as a whole and the scheduler that started it can restart it. So it does
    if a query is silent for ``stall_seconds``, which must be longer than a trigger
    may take. Returns what the queries reported.
    """
    own = {str(query.runId) for query in queries}
    with Watch().attach(spark) as watch:
        stalled: list[Seen] = []
        watch.expect(queries)
        try:
            while all(query.isActive for query in queries) and not stalled:
                try:
                    if stall_seconds is None:
                        spark.streams.awaitAnyTermination()
                    else:
                        spark.streams.awaitAnyTermination(max(1, int(stall_seconds / 2)))
                        stalled = [s for run, s in watch.stalled(stall_seconds).items() if run in own]
                except StreamingQueryException:
                    # Ours is raised below; the session may run queries of others.
                    pass
                spark.streams.resetTerminated()
        finally:
            for query in queries:
                query.stop()
    for query in queries:
        if query.exception() is not None:
            raise query.exception()
    if stalled:
        raise StalledQuery(f"no report for {stall_seconds} s: {', '.join(s.name for s in stalled)}")
    return watch
