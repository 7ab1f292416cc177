"""Exact distinct customers of any period, from stored bitmaps that merge.

Customers have dense numbers; a bitmap holds which of 32,768 consecutive numbers ordered on a day. Bitmaps of several days merge by
bitwise or, so a month, a quarter or any other set of days is counted out of the same stored rows, without looking
at an order again; counts of plain numbers would not add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.ranking import placed_rows


def customer_numbers(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``customer_id`` and ``number``, from 1 without gaps; customers that ``known`` has keep theirs."""
    ids = orders.select("customer_id").filter(F.col("customer_id").isNotNull()).distinct()
    first = F.lit(1)
    if known is not None:
        ids = ids.join(known, "customer_id", "left_anti")
        first = F.lit((known.agg(F.max("number")).first()[0] or 0) + 1)
    new = placed_rows(ids, [F.col("customer_id")]).select("customer_id", (F.col("_place") + first).cast("long").alias("number"))
    return new if known is None else known.select("customer_id", "number").unionByName(new)


def day_bitmaps(orders: DataFrame, numbers: DataFrame) -> DataFrame:
    """``order_date``, ``bucket`` and ``bitmap``: the customers of a day whose numbers fall into a bucket."""
    pairs = orders.select("order_date", "customer_id").filter(F.col("customer_id").isNotNull()).join(numbers, "customer_id")
    return pairs.groupBy("order_date", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def customers_by(bitmaps: DataFrame, period: Column) -> DataFrame:
    """``period_start`` and ``unique_customers`` of each period that ``order_date`` falls into."""
    merged = bitmaps.groupBy(period.alias("period_start"), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("period_start").agg(F.sum(F.bitmap_count("bitmap")).alias("unique_customers"))


def customers_by_period(bitmaps: DataFrame) -> DataFrame:
    """The distinct customers of every day, month and quarter."""
    periods = {"day": F.col("order_date"), "month": F.trunc("order_date", "month"), "quarter": F.trunc("order_date", "quarter")}
    found = [customers_by(bitmaps, c).select(F.lit(name).alias("period"), "period_start", "unique_customers") for name, c in periods.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])
