"""A keyed table kept current by a stream of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lakesync.plans.changed import ChangedTable


def stream_upsert(
    changes: DataFrame,
    table: ChangedTable,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Start the job. ``checkpoint`` lies in shared storage and is kept between runs.

    Batches are known by the id that the checkpoint gives the query: a restart goes on with its numbers, and a
    new checkpoint is another source, whose numbers mean nothing to the first.
    """

    def merge(batch: DataFrame, number: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the batch does not tell its query")
        table.merge_batch(batch, number, query_id)

    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
