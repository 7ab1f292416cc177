"""Incremental feed ingestion: new files merge into a table, one batch at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from martlet.sources.keyed import KeyedTable, MergedTable
from martlet.sources.tables import Tables


def stream_feed(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A file stream over a feed folder; ``max_files`` bounds the files per batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def ingest_stream(
    feed: DataFrame,
    target: KeyedTable,
    checkpoint: str,
    order: list[Column],
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Append the unseen keys of each batch to ``target``, one load for each batch.

    A batch reads the key columns of the buckets that its own keys fall into, of a number of
    folders that grows with the logarithm of the batches. It replaces its load when it is
    replayed, and earlier loads decide what is new, so the result does not depend on how often it ran.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        target.insert_ignore(batch_id, shape(batch), order)

    return (
        feed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_stream(
    feed: DataFrame,
    tables: Tables,
    table: str,
    checkpoint: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> StreamingQuery:
    """Upsert each batch into a versioned table with ``merge(stored, batch)``.

    The merges of this package give the same rows when a batch is replayed: updated
    columns hold the last record of the batch again, all others stay.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        tables.overwrite(table, merge(tables.read(table), batch))

    return (
        feed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    feed: DataFrame, target: MergedTable, checkpoint: str, order: list[str], touched_at: dt.datetime | None = None
) -> StreamingQuery:
    """Upsert each batch into ``target``, one load for each: what is written is the batch, not the table.

    Load 0 is the table as it was before; a batch replaces its load when it is replayed.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        target.upsert(batch_id + 1, batch, order, touched_at)

    return (
        feed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
