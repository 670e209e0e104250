"""Waiting for, reading from and stopping streaming queries."""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Report(NamedTuple):
    batch: int
    rows: int
    dropped: int  # rows that the stateful operators dropped as too late
    watermark: str | None


class Reports(StreamingQueryListener):
    """Every progress report of the queries that run while it listens; a query itself keeps only the last 100."""

    def __init__(self) -> None:
        self._by_run: dict[str, list[Report]] = defaultdict(list)
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self._by_run[str(p.runId)].append(Report(
            p.batchId, p.numInputRows, sum(s.numRowsDroppedByWatermark for s in p.stateOperators[:1]),
            p.eventTime.get("watermark")))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.add(str(event.runId))

    def of(self, query: StreamingQuery, timeout: float = 30.0) -> list[Report]:
        """The reports of a query that has ended, in order; they arrive a moment after its end."""
        end = time.monotonic() + timeout
        while str(query.runId) not in self._ended:
            if time.monotonic() > end:
                raise TimeoutError(f"the end of the query was not reported in {timeout} s")
            time.sleep(0.05)
        return sorted(self._by_run[str(query.runId)])


@contextmanager
def reports(spark: SparkSession) -> Iterator[Reports]:
    """Listen to all queries started inside the block."""
    listener = Reports()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def is_stream(df: DataFrame) -> bool:
    return df.isStreaming


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait until a query has processed what is there: its end for a one-pass trigger.

    Not for endless sources such as `rate`: use `wait_for_batches` there.
    """
    query.processAllAvailable()
    return query


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a one-pass query to end; raises what made it fail."""
    query.awaitTermination()
    return query


def wait_for_batches(query: StreamingQuery, batches: int = 1, timeout: float = 60.0) -> int:
    """Wait until a running query has finished some batches; the number seen."""
    end = time.monotonic() + timeout
    while time.monotonic() < end:
        if query.exception():
            raise query.exception()
        seen = [p for p in query.recentProgress if p["numInputRows"] > 0]
        if len(seen) >= batches:
            return len(seen)
        time.sleep(0.2)
    raise TimeoutError(f"fewer than {batches} batches in {timeout} s")


def last_batch(query: StreamingQuery) -> int | None:
    return query.lastProgress["batchId"] if query.lastProgress else None


def current_watermark(query: StreamingQuery) -> str | None:
    return (query.lastProgress or {"eventTime": {}})["eventTime"].get("watermark")


def active_names(spark: SparkSession) -> list[str]:
    return sorted(q.name or str(q.id) for q in spark.streams.active)


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()
