"""Daily revenue kept current from a stream of clean orders, without reading an order twice.

The state are two tables of mergeable parts: ``visits``, each customer once for each day, and ``days``, of each batch the
sums of the days it touches. All measures are sums over the parts of a day; a batch adds to the customers of a day those
that ``visits`` did not have. Orders themselves are not stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlet.plans import gold
from martlet.sources.keyed import BUCKET, KeyedTable

#: Buckets of the days, so that a batch reads the visits of its own days and few others.
DAY_BUCKETS = 32


def visits_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, f"{root}/visits", ["order_date", "customer_id"], DAY_BUCKETS, bucket_by=["order_date"])


def days_table(spark: SparkSession, root: str) -> KeyedTable:
    """A row for each day and load; merged loads have one row a day."""
    return KeyedTable(spark, f"{root}/days", ["revenue_date"], 1, fold=gold.merged_parts)


def revenue_stream(orders: DataFrame, root: str) -> StreamingQuery:
    """Add each batch of orders to the days it touches, however late they are.

    A batch replaces its two loads when it is replayed. It reads the visits of the buckets of its days and
    nothing else of earlier batches, so no order is ever late and counts of customers are exact.
    """
    spark = orders.sparkSession
    visits, days = visits_table(spark, root), days_table(spark, root)

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            seen = batch.select("order_date", "customer_id").filter(F.col("customer_id").isNotNull())
            visits.insert_ignore(batch_id, seen)
            first = visits.read_load(batch_id)
            days.store(batch_id, gold.daily_parts(batch, [] if first is None else [first.drop(BUCKET)]))
        finally:
            batch.unpersist()

    return (
        orders.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def current_daily_revenue(spark: SparkSession, root: str) -> DataFrame:
    """All days with growth: the merged parts of each."""
    parts = days_table(spark, root).read()
    if parts is None:
        raise ValueError(f"no orders have arrived in {root}")
    return gold.with_growth(gold.daily_measures(gold.merged_parts(parts.drop(BUCKET))))


def run_daily_revenue(spark: SparkSession, orders: DataFrame, root: str) -> DataFrame:
    """Process everything available and read the current days back."""
    revenue_stream(orders, root).awaitTermination()
    return current_daily_revenue(spark, root)
