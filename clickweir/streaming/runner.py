"""Starting, recovering and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickweir.operators.shaping import cached

# Micro-batch cadence of the programs (fixed values).
STATISTICS_INTERVAL = "5 seconds"
ORDER_ETL_INTERVAL = "2 seconds"
OFFSET_ETL_INTERVAL = "3 seconds"

BatchFunction = Callable[[DataFrame, int], None]


def foreach_batch(
    df: DataFrame,
    fn: BatchFunction,
    checkpoint: str,
    mode: str = "update",
    interval: str | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    """A writer that hands each non-empty micro-batch and its id to ``fn``.

    The micro-batch is kept while ``fn`` runs, so reading it several times neither
    reads the source nor updates the state again.

    ``checkpoint`` belongs on storage every executor reaches: restarting with it
    resumes offsets and state. Without ``interval`` the query processes what is
    available, in as many micro-batches as the source's limit asks for, and ends.
    """

    def skip_empty(batch: DataFrame, batch_id: int) -> None:
        with cached(batch):
            if not batch.isEmpty():
                fn(batch, batch_id)

    writer = (
        df.writeStream.foreachBatch(skip_empty)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


@contextmanager
def running(writer: DataStreamWriter):
    """Lend out a started query and stop it whatever happens."""
    query = writer.start()
    try:
        yield query
    finally:
        query.stop()


def run_query(
    writer: DataStreamWriter,
    body: Callable[[StreamingQuery], None] | None = None,
    timeout: float | None = None,
) -> StreamingQuery:
    """Start a query, run ``body`` with it or await its end, then stop it.

    A failure of the query is raised to the caller.
    """
    with running(writer) as query:
        if body is not None:
            body(query)
        else:
            query.awaitTermination(timeout) if timeout else query.awaitTermination()
    return query
