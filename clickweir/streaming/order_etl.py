"""Online order ETL: routed keyed storage with a ledger of consumed offsets."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from clickweir import storage
from clickweir.sinks.routed import keyed_orders, write_routed, write_runs
from clickweir.streaming.runner import BatchFunction

_LOG = logging.getLogger(__name__)
LEDGER_KEYS = ["topic", "partition"]


def until_offsets(messages: DataFrame) -> DataFrame:
    """Per topic partition the offset after the last consumed message."""
    return messages.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("until_offset")
    )


def commit_offsets(messages: DataFrame, ledger: str) -> None:
    """Save how far each topic partition was consumed; run after storing the batch."""
    storage.upsert_table(until_offsets(messages), ledger, LEDGER_KEYS)


def log_routing(batch_id: int, counts: dict[str, int]) -> None:
    """Report the messages of a micro-batch that were left out."""
    if counts["rejected"]:
        _LOG.warning("batch %s: %s of %s messages without an order id", batch_id,
                     counts["rejected"], counts["received"])


def store_orders(
    root: str, ledger: str | None = None, report=log_routing, write=write_routed
) -> BatchFunction:
    """Store each micro-batch by sink and order id, then commit its offsets.

    ``write`` is ``write_routed``, or ``write_runs`` for a table that the stream folds itself.
    ``report`` gets the batch's id and its counts of received, stored and rejected messages.

    Storing is idempotent per batch and offsets are saved last, so a failure in
    between repeats work without changing the result.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        # A batch that the table has already is not read, so nothing was seen.
        if write(keyed_orders(batch, seen), root, batch_id) is not False:
            report(batch_id, seen.get)
        if ledger is not None:
            commit_offsets(batch, ledger)

    return store
