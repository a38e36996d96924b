"""Running several streams: notice the first that fails, restart it from its checkpoint, report progress."""

from __future__ import annotations

import logging
import time
from collections import deque
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)


class Progress(StreamingQueryListener):
    """The latest progress of each query and the errors of those that ended; add it with `spark.streams.addListener`."""

    def __init__(self, kept: int = 100) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.errors: deque[tuple[str, str]] = deque(maxlen=kept)

    def onQueryStarted(self, event) -> None:
        log.info("query %s started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        key = str(p.id)  # the same after a restart from the checkpoint
        self.rows[key] = self.rows.get(key, 0) + p.numInputRows
        self.batches[key] = p.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.errors.append((str(event.id), event.exception))


def wait(*queries: StreamingQuery, poll: float = 0.5) -> None:
    """Until all have ended by themselves. The first that fails, whichever it is, stops the others and is raised."""
    waiting = list(queries)
    while waiting:
        for query in [q for q in waiting if not q.isActive]:
            waiting.remove(query)
            error = query.exception()
            if error is not None:
                for other in waiting:
                    other.stop()
                raise error
        if waiting:
            _pause(waiting[0], poll)


def _pause(query: StreamingQuery, seconds: float) -> None:
    try:
        query.awaitTermination(max(1, round(seconds)))
    except Exception:  # looked at by its owner, through `exception`
        pass


def supervised(starters: Mapping[str, Callable[[], StreamingQuery]], restarts: int = 3, pause: float = 1.0, poll: float = 0.5) -> dict[str, int]:
    """Run streams until all have ended, each restarted from its checkpoint when it fails.

    `starters` start a query with the same checkpoint each time. A stream that fails more than `restarts` times
    without a batch done in between stops all others and is raised. Returns how often each was restarted.
    Sinks whose repeated batch replaces what the first try wrote (all of this package) have no second effect.
    """
    running = {name: start() for name, start in starters.items()}
    tries, count, reached = dict.fromkeys(running, 0), dict.fromkeys(running, 0), dict.fromkeys(running, -1)
    try:
        while running:
            for name, query in [(n, q) for n, q in running.items() if not q.isActive]:
                error = query.exception()
                del running[name]
                if error is None:
                    continue
                done = query.lastProgress["batchId"] if query.lastProgress else -1
                tries[name] = tries[name] + 1 if done <= reached[name] else 1
                reached[name] = max(done, reached[name])
                if tries[name] > restarts:
                    raise error
                log.warning("stream %s failed, restart %s: %s", name, tries[name], error)
                time.sleep(pause)
                running[name] = starters[name]()
                count[name] += 1
            if running:
                _pause(next(iter(running.values())), poll)
    finally:
        for query in running.values():
            query.stop()
    return count


def stop_named(spark: SparkSession, *names: str) -> None:
    for query in spark.streams.active:
        if query.name in names:
            query.stop()
