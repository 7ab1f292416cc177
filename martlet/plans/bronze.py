"""Loading feeds into the bronze tables with their write modes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.merge import insert_ignore, merge_subset
from martlet.sources.feeds import flatten_products, with_lineage, with_raw_json

# Columns a second delivery of a known key may change.
CUSTOMER_UPDATES = ["total_lifetime_spend", "loyalty_tier", "is_active"]
CAMPAIGN_UPDATES = ["actual_spend", "ingestion_timestamp"]


#: What a product version is known by.
PRODUCT_VERSION = ["product_id", "ingestion_timestamp"]


def product_order() -> list[Column]:
    """Which record of a product version counts."""
    return [F.col("price").asc_nulls_last()]


def new_orders(target: DataFrame | None, batch: DataFrame, arrival: list[Column]) -> DataFrame:
    """Order rows to append; the first record of an order id wins, for ever."""
    return insert_ignore(target, batch, ["order_id"], arrival)


def new_product_versions(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Product versions to append, one per product and ingestion time."""
    return insert_ignore(target, batch, PRODUCT_VERSION, product_order())


def merge_customers(target: DataFrame, batch: DataFrame, arrival: list[str], touched_at) -> DataFrame:
    return merge_subset(
        target, batch, ["customer_id"], CUSTOMER_UPDATES, arrival, touch_col="last_modified_date", touched_at=touched_at
    )


def merge_campaigns(target: DataFrame, batch: DataFrame, arrival: list[str]) -> DataFrame:
    return merge_subset(target, batch, ["campaign_id"], CAMPAIGN_UPDATES, arrival)


def stamped(name: str, feed: DataFrame, run_id: str, at: dt.datetime, payload: bool = True) -> DataFrame:
    """Feed records with what the bronze table adds: payload, lineage and a row id.

    Columns a feed brings along stay as they are. Products and orders keep the record
    as received, unless the ``payload`` is left to the caller.
    """
    df = feed
    if payload and name in ("products", "orders") and "raw_json" not in df.columns:
        df = with_raw_json(df)
    if name == "products" and "product_id" not in df.columns:
        df = flatten_products(df)
    if "pipeline_run_id" not in df.columns:
        df = with_lineage(df, f"{name}_feed", run_id, at)
    if name == "inventory" and "inventory_id" not in df.columns:
        df = df.withColumn(
            "inventory_id", F.xxhash64("product_id", "warehouse_location", "inventory_date", "pipeline_run_id")
        )
    return df
