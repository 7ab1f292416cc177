"""Order cells: sums of orders by customer, product, day and promotion code, and their roll-ups.

Every measure of the marts is a sum, a count of cells or the least order, so it can be taken from any roll-up that keeps the
columns it groups by. The functions of the marts therefore take orders or cells: orders are read as cells of one order each,
a projection without an exchange; stored cells hold many orders each and are read instead of them.

    orders -> order_cells (day, customer, product, code) -> customer_days (day, customer)
                                                         -> product_days (day, product, code)

The stored roll-ups have the month folders of the orders, and a run rewrites the months it has changed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.sources.tables import Tables

#: The columns that each stored roll-up groups by, besides the month.
LEVELS = {
    "order_cells": ["order_date", "customer_id", "product_id", "promo_code"],
    "customer_days": ["order_date", "customer_id"],
    "product_days": ["order_date", "product_id", "promo_code"],
}

#: Measures that add up, with the type of their sums: counts of orders by status, of those with a code and of completed
#: ones with an amount; items of all orders and units of completed ones; amounts of completed orders, discounts of all.
SUMS = {
    "n_orders": "bigint", "n_completed": "bigint", "n_pending": "bigint", "n_cancelled": "bigint", "n_coded": "bigint",
    "n_valued": "bigint", "items": "bigint", "units": "bigint", "revenue": "decimal(20,2)", "listed": "decimal(31,2)",
    "discount": "decimal(20,2)",
}


def total(name: str) -> Column:
    """The sum of a measure; NULL where no cell has a value."""
    return F.sum(name).cast(SUMS[name])


def is_cells(orders: DataFrame) -> bool:
    return "n_completed" in orders.columns


def as_cells(orders: DataFrame) -> DataFrame:
    """Orders as cells of one order each; cells as they are."""
    if is_cells(orders):
        return orders
    done = F.col("status") == "completed"

    def one(test: Column) -> Column:
        return F.when(test, 1).otherwise(0)

    made = {
        "n_orders": F.lit(1),
        "n_completed": one(done),
        "n_pending": one(F.col("status") == "pending"),
        "n_cancelled": one(F.col("status") == "cancelled"),
        "n_coded": one(F.col("promo_code").isNotNull()),
        "n_valued": one(done & F.col("final_amount").isNotNull()),
        "items": F.col("quantity"),
        "units": F.when(done, F.col("quantity")),
        "revenue": F.when(done, F.col("final_amount")),
        "listed": F.when(done, F.col("unit_price") * F.col("quantity")),
        "discount": F.col("discount_amount"),
    }
    if "order_timestamp" in orders.columns:
        made |= {
            "first_timestamp": F.when(done, F.col("order_timestamp")),
            "first_order_id": F.when(done, F.col("order_id")),
        }
    month = ["order_month"] if "order_month" in orders.columns else []
    return orders.select(*LEVELS["order_cells"], *month, *[c.alias(n) for n, c in made.items()])


def completed(orders: DataFrame) -> DataFrame:
    """Cells with a completed order; their sums of units and amounts are those of completed orders anyway."""
    if is_cells(orders):
        return orders.filter("n_completed > 0")
    return as_cells(orders.filter(F.col("status") == "completed"))


def rolled_up(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``cells`` summed by fewer keys. The code becomes that of the first completed order unless it is a key."""
    first = F.struct("first_timestamp", "first_order_id")
    known = F.when(F.col("first_order_id").isNotNull(), first)
    least = {"first_timestamp": F.min(known)["first_timestamp"], "first_order_id": F.min(known)["first_order_id"]}
    if "promo_code" not in keys:
        least["promo_code"] = F.min_by("promo_code", known)
    return cells.groupBy("order_month", *keys).agg(
        *[total(c).alias(c) for c in SUMS], *[c.alias(n) for n, c in least.items()]
    )


def update_cells(tables: Tables, months: list[dt.date] | None, run_id: str | None = None) -> None:
    """Rebuild the roll-ups of these months (None: all) from the stored orders: one scan of them, level by level."""

    def changed(table: str) -> DataFrame:
        stored = tables.read(table)
        return stored if months is None else stored.filter(F.col("order_month").isin(months))

    # Most cells hold one order, so nothing would be combined before an exchange. Ranges of the keys serve both the sums and the month folders.
    orders = as_cells(changed("silver_orders")).repartitionByRange("order_month", "order_date", "customer_id", "product_id")
    tables.overwrite("order_cells", rolled_up(orders, LEVELS["order_cells"]), run_id, placed=True)
    # Cells of a customer and day lie together, so they are summed before they move; those of a product and day are far apart.
    tables.overwrite("customer_days", rolled_up(changed("order_cells"), LEVELS["customer_days"]), run_id)
    cells = changed("order_cells").repartitionByRange("order_month", "order_date", "product_id")
    tables.overwrite("product_days", rolled_up(cells, LEVELS["product_days"]), run_id, placed=True)


def stored_cells(tables: Tables) -> dict[str, DataFrame]:
    """The stored roll-ups; built first where a lake has orders but no cells yet."""
    if not all(tables.exists(table) for table in LEVELS):
        update_cells(tables, None)
    return {table: tables.read(table) for table in LEVELS}
