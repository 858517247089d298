"""Micro-batch driver of the same store: each batch of documents is one plan and one version.

A version notes the stream and its batch, so a batch that is run again after a failure changes nothing. Without a time of its own a batch
has the time at which it is first seen, which a file beside the checkpoint keeps for a repetition.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import pipelines as P
from tidemark.plans.parse import parse_documents, split_rejected
from tidemark.sources.state import Snapshots


def _time_of(state: Snapshots, writer: str, batch: int) -> datetime:
    """The time of a batch: that of its first run."""
    path = f"{state.root}/batches/{writer}-{batch}"
    if not state.noted(path):
        state.note(path, datetime.now(timezone.utc).isoformat())
    return datetime.fromisoformat(state.noted(path))


def store_stream(docs: DataFrame, state: Snapshots, checkpoint: str, run_ts: datetime | None = None, writer: str = "stream"):
    """Start a stream over (ord, doc) that stores what is available now and ends. Rejected rows go to the quarantine."""

    def store(batch: DataFrame, number: int) -> None:
        if state.done(writer) >= number:
            return
        at = run_ts or _time_of(state, writer, number)
        try:
            parsed = parse_documents(batch, F.lit(at))
            parsed = state.stage(parsed if "bill_id" in parsed.columns else parsed.withColumn("bill_id", F.col("legiscan_id")))
            records, bad = split_rejected(parsed)
            P._set_apart(state, bad, f"{writer}-{number}")
            P._store(state, state.read(), records, F.lit(at), (writer, number))
        finally:
            state.unstage()

    return docs.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
