"""Publishing notifications, and dropping those sent twice."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quadloom.functions.times import format_instant

FIELDS = ("id", "object", "agents", "types", "objectTypes", "created")
MESSAGES = "id STRING, message STRING, reason STRING"


def serialize(notifications: DataFrame) -> DataFrame:
    """(id, message): each notification as JSON, absent fields left out."""
    fields = [F.col(c) for c in FIELDS[:-1]] + [format_instant("created").alias("created")]
    return notifications.select("id", F.to_json(F.struct(*fields)).alias("message"))


Publisher = Callable[[DataFrame], DataFrame]


def per_message(send: Callable[[str, str], None]) -> Publisher:
    """A publisher that calls ``send(id, message)`` in tasks; what it raises is the reason of that message alone."""

    def attempt(id_: str, message: str) -> str | None:
        try:
            send(id_, message)
        except Exception as problem:  # one message must not end the others
            return str(problem)
        return None

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = zip(part["id"], part["message"], part["reason"], strict=True)
            yield part.assign(reason=[r if isinstance(r, str) else attempt(i, m) for i, m, r in rows])

    return lambda messages: messages.mapInPandas(run, MESSAGES)


def emit(
    notifications: DataFrame,
    out: str,
    checkpoint: str,
    publish: Publisher | None = None,
    **trigger,
) -> StreamingQuery:
    """Publish a stream of notifications, each batch in one pass.

    ``publish`` takes (id, message, reason) and gives the same rows back, with
    a reason for each it could not send; rows that have one already it must
    not send. Null notifications have one from the start. Without ``publish``
    the folder ``out`` itself is the topic.

    All rows go to ``out/batch=<n>``, those without a reason as published. A
    batch that fails as a whole is kept with the reason, and the stream goes
    on. Folders are named by their batch, so a batch run again after a failure
    replaces what it wrote before.
    """

    def keep(rows: DataFrame, batch: int) -> None:
        rows.select("id", "message", "reason").write.mode("overwrite").parquet(f"{out}/batch={batch}")

    def run(rows: DataFrame, batch: int) -> None:
        refused = F.when(F.col("id").isNull(), F.lit("null notification"))
        messages = serialize(rows).withColumn("reason", refused.cast("string"))
        try:
            keep(publish(messages) if publish else messages, batch)
        except Exception as problem:  # publishing must never end the stream
            keep(messages.withColumn("reason", F.coalesce("reason", F.lit(str(problem)))), batch)

    writer = notifications.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# Kept on disk beside the task, and as changes in the checkpoint, so neither memory nor a batch's reading grows with all ids.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def dedup(notifications: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each notification once to ``out``, however late or far apart its copies come.

    Ids that were seen are state of the stream, in RocksDB below ``checkpoint``:
    a batch looks up its own ids and reads nothing of earlier batches. Exact
    over all ids; of copies in one batch any one is kept. A batch run again
    replaces what it wrote before. Null ids are kept as they come.
    """

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    once = notifications.filter("id IS NOT NULL").dropDuplicates(["id"])
    rows = once.unionByName(notifications.filter("id IS NULL"))
    writer = rows.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    conf = notifications.sparkSession.conf
    before = {name: conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        conf.set(name, value)
    try:  # a query takes the settings that it is started with
        return writer.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        for name, value in before.items():
            conf.unset(name) if value is None else conf.set(name, value)
