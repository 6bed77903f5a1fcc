"""What goes on: batches of streams by a listener, tasks of a running stage by the status tracker."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..sources import files


class Batches(StreamingQueryListener):
    """Keeps ``query, batch, rows, seconds`` of each batch that ended."""

    def __init__(self) -> None:
        self.batches: list[dict] = []
        self.ended: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append({"query": str(p.id), "batch": p.batchId, "rows": p.numInputRows, "seconds": p.durationMs.get("triggerExecution", 0) / 1000})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.append(str(event.id))


@contextmanager
def listened(spark: SparkSession) -> Iterator[Batches]:
    """The batches of all streams of a session while in the block."""
    listener = Batches()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


@contextmanager
def watched(spark: SparkSession, path: str, every: float = 5.0, **facts) -> Iterator[None]:
    """While in the block, ``path`` says each ``every`` seconds how many tasks of the running Spark stages are done."""
    tracker, stop, began = spark.sparkContext.statusTracker(), threading.Event(), time.time()

    def say(running: bool) -> None:
        infos = [i for i in map(tracker.getStageInfo, tracker.getActiveStageIds()) if i] if running else []
        told = {"running": running, "seconds": round(time.time() - began, 3), "tasks_done": sum(i.numCompletedTasks for i in infos), "tasks": sum(i.numTasks for i in infos)}
        files.put_text(spark, path, json.dumps(facts | told))

    def loop() -> None:
        while not stop.wait(every):
            say(True)

    say(True)
    thread = threading.Thread(target=loop, daemon=True)
    thread.start()
    try:
        yield
    finally:
        stop.set()
        thread.join()
        say(False)
