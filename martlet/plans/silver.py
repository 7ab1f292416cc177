"""Clean tables: gates, latest rows and enrichment.

Each transform returns ``(clean, quarantined)``. Quarantined rows keep the table
key and the names of the broken rules.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet import schemas
from martlet.functions import labels
from martlet.functions.dates import day, order_time_parts
from martlet.functions.ordering import largest_first
from martlet.operators.latest import latest_per_key
from martlet.operators.merge import merge_subset
from martlet.operators.quality import failed_rules, gate, unique_on, with_known_flag

# Columns a later run may change in rows that exist already.
UPDATES = {
    "silver_products": [
        "product_name", "price", "description", "category", "image_url", "average_rating", "review_count", "price_tier",
    ],
    "silver_customers": [
        "full_name", "email", "phone", "city", "state", "loyalty_tier", "total_lifetime_spend", "is_active",
        "customer_age_days", "customer_segment",
    ],
    "silver_orders": ["status"],
    "silver_campaigns": ["campaign_name", "actual_spend", "is_active"],
}

Split = tuple[DataFrame, DataFrame]


def _rejects(quarantined: DataFrame, key: str) -> DataFrame:
    return quarantined.select(F.col(key).cast("string").alias("record_key"), "reasons")


def merge(table: str, target: DataFrame, clean: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Bring ``clean`` into an existing clean table; rows it lacks stay as they are.

    If the target has audit columns, matched rows are marked as updated at ``at`` and new ones as created.
    """
    key = list(schemas.TABLES[table].key)
    merged = merge_subset(target, clean, key, UPDATES[table], key, touch_col="updated_at", touched_at=at)
    return schemas.stamped(merged, table, at) if "updated_at" in target.columns else merged


def with_month(orders: DataFrame) -> DataFrame:
    """The partition column of the stored orders."""
    return orders.withColumn("order_month", F.trunc("order_date", "month"))


def changed_orders(target: DataFrame, clean: DataFrame) -> DataFrame:
    """Clean orders that are new or have another status, with the month of the stored row."""
    held = target.select("order_id", F.col("status").alias("_held"), F.col("order_month").alias("_held_month"))
    differs = F.col("_held").isNull() | (F.col("_held") != F.col("status"))
    return (
        with_month(clean).join(held, "order_id", "left").filter(differs)
        .withColumn("order_month", F.coalesce("_held_month", "order_month"))
        .drop("_held", "_held_month")
    )


def latest_products(bronze: DataFrame) -> DataFrame:
    """Newest version with a valid price; a bad newest version exposes the one before."""
    return latest_per_key(bronze.filter("price > 0"), ["product_id"], [largest_first("ingestion_timestamp")])


def product_winners(versions: DataFrame) -> DataFrame:
    """One version per product: the newest with a valid price, or the newest of all if none has one.

    What a run has to know of earlier loads: the winner among winners and new versions is that of all versions.
    """
    valid = F.coalesce(F.col("price") > 0, F.lit(False)).desc()
    return latest_per_key(versions, ["product_id"], [valid, largest_first("ingestion_timestamp")])


def silver_products(bronze: DataFrame) -> Split:
    priced, unpriced = gate(bronze, {"price_positive": F.col("price") > 0})
    latest = latest_per_key(priced, ["product_id"], [largest_first("ingestion_timestamp")])
    shaped = latest.select(
        "product_id",
        F.col("title").alias("product_name"),
        "price",
        "description",
        "category",
        "image_url",
        F.col("rating_rate").alias("average_rating"),
        F.col("rating_count").alias("review_count"),
        labels.price_tier(F.col("price")).alias("price_tier"),
        F.lit(True).alias("is_active"),
        labels.quality_score(
            F.col("title"), F.col("description"), F.col("image_url"), F.col("rating_rate")
        ).alias("data_quality_score"),
    )
    clean, broken = gate(shaped, schemas.schema_rules("silver_products"))
    return clean, _rejects(unpriced, "product_id").unionByName(_rejects(broken, "product_id"))


def free_emails(valid: DataFrame, stored: DataFrame) -> Split:
    """Rows whose e-mail no other stored customer holds, and those whose e-mail one does.

    The stored holder of an address keeps it, until a run in which the holder has left it has passed.
    """
    held = stored.filter("email is not null").select(F.col("email").alias("_held"), F.col("customer_id").alias("_holder"))
    placed = valid.join(held, F.col("email") == F.col("_held"), "left")
    taken = F.coalesce(F.col("_holder") != F.col("customer_id"), F.lit(False))
    return placed.filter(~taken).select(*valid.columns), placed.filter(taken).select(*valid.columns)


def silver_customers(bronze: DataFrame, as_of: dt.date, stored: DataFrame | None = None) -> Split:
    """Clean customers; ``stored`` are those of earlier runs, whose e-mails are taken."""
    age = F.datediff(day(as_of), "signup_date")
    shaped = schemas.with_defaults(bronze, "silver_customers").select(
        "customer_id",
        labels.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        F.lower("email").alias("email"),
        "phone",
        "city",
        "state",
        "country",
        "signup_date",
        "loyalty_tier",
        "total_lifetime_spend",
        "is_active",
        age.alias("customer_age_days"),
        labels.lifecycle_segment(age, F.col("total_lifetime_spend"), F.col("is_active")).alias("customer_segment"),
    )
    rules = {
        "email_valid": labels.valid_email(F.col("email")),
        "spend_known": F.col("total_lifetime_spend").isNotNull(),
        **schemas.schema_rules("silver_customers"),
    }
    valid, broken = gate(shaped, rules)
    free, taken = (valid, valid.limit(0)) if stored is None else free_emails(valid, stored)
    clean, repeated = unique_on(free, ["email"], keep="customer_id")
    repeated = repeated.unionByName(taken).withColumn("reasons", F.array(F.lit("duplicate_email")))
    return clean, _rejects(broken, "customer_id").unionByName(_rejects(repeated, "customer_id"))


def order_rules() -> dict:
    return {
        "discount_known": F.col("discount_amount").isNotNull(),
        **schemas.schema_rules(
            "silver_orders",
            ["order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "order_timestamp",
             "status", "payment_method", "promo_code"],
        ),
    }


def clean_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders whose customer and product are in bronze and whose amounts are positive.

    Both existence tests are semi joins; the gate runs below them, at the scan.
    """
    sound, _ = gate(schemas.with_defaults(orders, "silver_orders"), order_rules())
    known = sound.join(customers.select("customer_id"), "customer_id", "left_semi").join(
        products.select("product_id"), "product_id", "left_semi"
    )
    return _shaped_orders(known)


def _shaped_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "discount_amount",
        "final_amount",
        *[c.alias(n) for n, c in order_time_parts(F.col("order_timestamp")).items()],
        "order_timestamp", "status", "payment_method", "promo_code",
        (F.col("discount_amount") > 0).alias("is_discounted"),
    ).select(*schemas.column_names("silver_orders"))


def judged_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every order with the names of the rules it breaks, in one pass: what is clean and what is rejected are filters of it."""
    orders = schemas.with_defaults(orders, "silver_orders")
    flagged = with_known_flag(
        with_known_flag(orders, customers, "customer_id", "known_customer"), products, "product_id", "known_product"
    )
    rules = {
        "customer_known": F.col("known_customer"), "product_known": F.col("known_product"), **order_rules(),
    }
    return flagged.withColumn("reasons", failed_rules(rules)).drop("known_customer", "known_product")


def split_orders(judged: DataFrame) -> Split:
    """Clean and rejected orders of ``judged_orders``, which should be stored if both are used."""
    clean = _shaped_orders(judged.filter(F.size("reasons") == 0))
    return clean, _rejects(judged.filter(F.size("reasons") > 0), "order_id")


def pending_orders(judged: DataFrame) -> DataFrame:
    """Rejected orders that only lack a customer or product, which may still arrive."""
    lacking = F.array(F.lit("customer_known"), F.lit("product_known"))
    waits = (F.size("reasons") > 0) & (F.size(F.array_except("reasons", lacking)) == 0)
    return judged.filter(waits).select(*schemas.column_names("pending_orders"))


def rejected_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    return split_orders(judged_orders(orders, customers, products))[1]


def latest_inventory(bronze: DataFrame) -> DataFrame:
    """Newest non-negative snapshot per product."""
    order = [largest_first("inventory_date"), largest_first("ingestion_timestamp"), largest_first("inventory_id")]
    return latest_per_key(bronze.filter("stock_quantity >= 0"), ["product_id"], order)


def silver_inventory(bronze: DataFrame) -> Split:
    _, negative = gate(bronze, {"stock_not_negative": F.col("stock_quantity") >= 0})
    shaped = latest_inventory(bronze).select(
        "product_id",
        "stock_quantity",
        "warehouse_location",
        "reorder_point",
        "cost_price",
        labels.stock_status(F.col("stock_quantity"), F.col("reorder_point")).alias("stock_status"),
        F.coalesce(F.col("stock_quantity") * F.col("cost_price"), F.lit(0)).try_cast("decimal(12,2)").alias(
            "inventory_value"
        ),
        "inventory_date",
    )
    rules = {
        "inventory_value_fits": F.col("inventory_value").isNotNull(),
        **schemas.schema_rules("silver_inventory", shaped.columns),
    }
    clean, broken = gate(shaped, rules)
    return clean, _rejects(negative, "product_id").unionByName(_rejects(broken, "product_id"))


def silver_campaigns(bronze: DataFrame, as_of: dt.date) -> Split:
    shaped = bronze.select(
        "campaign_id", "campaign_name", "channel", "promo_code", "discount_percentage", "start_date", "end_date",
        "budget", "actual_spend",
        day(as_of).between(F.col("start_date"), F.col("end_date")).alias("is_active"),
    )
    rules = {
        "start_known": F.col("start_date").isNotNull(),
        "end_known": F.col("end_date").isNotNull(),
        **schemas.schema_rules("silver_campaigns"),
    }
    clean, broken = gate(shaped, rules)
    return clean, _rejects(broken, "campaign_id")
