"""The write path as a stream: ops appended to a log that is folded on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quadloom.sources.oplog import OpLog


def append_ops(
    ops: DataFrame, log: OpLog, checkpoint: str, compact_every: int | None = None, **trigger
) -> StreamingQuery:
    """Append a stream of ops to a log, batch by batch.

    A batch is a folder of the log, so one that is run again after a failure
    replaces itself. With ``compact_every`` the log is compacted after each
    that many batches, which bounds what a read has to fold.
    """

    def run(rows: DataFrame, batch: int) -> None:
        log.append(rows, batch)
        if compact_every and (batch + 1) % compact_every == 0:
            log.compact(batch)

    writer = ops.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
