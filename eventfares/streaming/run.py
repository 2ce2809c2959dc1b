"""Starting queries: the micro-batch clock, recovery, and what came too late."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from eventfares.settings import BATCH_INTERVAL

log = logging.getLogger(__name__)


def start(
    writer: DataStreamWriter, checkpoint: str, interval: str = BATCH_INTERVAL, once: bool = False
) -> StreamingQuery:
    """Start a query with one batch per `interval`, or, with `once`, run what has arrived and stop.

    `checkpoint` is a folder of the query's own on shared storage. A query started on it again goes
    on where the last one ended, with its state.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's recent batches dropped because they came behind its watermark."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


class LateRows(StreamingQueryListener):
    """Logs the rows that any query of the session drops as too late."""

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        if late:
            log.warning("%s: batch %s dropped %s late rows", event.progress.id, event.progress.batchId, late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_once(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything that has arrived, then return."""
    start(writer, checkpoint, once=True).awaitTermination()
