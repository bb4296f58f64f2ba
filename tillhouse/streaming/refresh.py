"""Running streams: triggered, continuous, and full refresh."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

TRIGGERED = "triggered"
CONTINUOUS = "continuous"


def _launch(writer: DataStreamWriter, mode: str, interval: str) -> StreamingQuery:
    if mode == TRIGGERED:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    if mode == CONTINUOUS:
        return writer.trigger(processingTime=interval).start()
    raise ValueError(f"unknown refresh mode: {mode}")


def side_by_side(tasks: Iterable[Callable[[], object]]) -> None:
    """Run independent jobs at once and wait for all; the first error is raised. Small jobs leave a cluster idle alone."""
    tasks = list(tasks)
    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        for done in [pool.submit(copy_context().run, task) for task in tasks]:
            done.result()


def append_to(
    df: DataFrame, path: str, checkpoint: str, mode: str = TRIGGERED, interval: str = "1 minute"
) -> StreamingQuery:
    """Append a stream to a parquet table, each input row exactly once.

    ``triggered`` takes in all that has arrived and returns when done; ``continuous`` keeps running. A full
    refresh is a triggered run with a new path and a new checkpoint.
    """
    writer = df.writeStream.format("parquet").outputMode("append")
    return _launch(writer.option("path", path).option("checkpointLocation", checkpoint), mode, interval)


def merge_into(
    df: DataFrame,
    merge: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = TRIGGERED,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Hand every micro-batch to ``merge(batch, batch_id)``, which must tolerate being given a batch twice."""
    here = copy_context()  # batches run in another thread
    writer = df.writeStream.foreachBatch(lambda batch, number: here.run(merge, batch, number))
    return _launch(writer.option("checkpointLocation", checkpoint), mode, interval)


class Running:
    """Several continuous queries as one: started in order, and when one fails, all stop.

    Restarting is starting again with the same checkpoints.
    """

    def __init__(self, start: dict[str, Callable[[], StreamingQuery]], poll: float = 0.5):
        self.queries: dict[str, StreamingQuery] = {}
        self._poll, self._ended = poll, threading.Event()
        try:
            for name, launch in start.items():
                self.queries[name] = launch()
        except Exception:
            self.stop()
            raise
        self._watcher = threading.Thread(target=self._watch, daemon=True)
        self._watcher.start()

    def _watch(self) -> None:
        while not self._ended.wait(self._poll):
            if not all(query.isActive for query in self.queries.values()):
                self._stop_all()
                return

    def _stop_all(self) -> None:
        for query in reversed(self.queries.values()):
            if query.isActive:
                query.stop()

    def errors(self) -> dict[str, str]:
        """What went wrong, by query."""
        found = {name: query.exception() for name, query in self.queries.items()}
        return {name: str(error) for name, error in found.items() if error is not None}

    @property
    def active(self) -> bool:
        return bool(self.queries) and all(query.isActive for query in self.queries.values())

    def take_in(self) -> None:
        """Wait until all that has arrived has gone through every query, in the order they were started."""
        for query in self.queries.values():
            query.processAllAvailable()

    def stop(self) -> None:
        """Stop all; raises if one had failed."""
        self._ended.set()
        self._stop_all()
        if self.errors():
            raise RuntimeError(f"stopped by a failure: {self.errors()}")
