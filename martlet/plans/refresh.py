"""One run over all layers: feeds to bronze, clean tables, marts and history.

The order of the steps is the order of the calls; every table is written once and
later steps read what was written. Every table knows the run that wrote it, so repeating
the newest run id starts from what that run found and gives the same tables, bronze included.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet import schemas
from martlet.functions import labels
from martlet.functions.dates import OPEN_END
from martlet.operators.history import scd2_apply, scd2_changes
from martlet.plans import bronze, extended, gold, silver
from martlet.plans.cells import stored_cells, update_cells
from martlet.session import dropped
from martlet.session import stored as pin
from martlet.sources.feeds import LINEAGE, with_raw_json
from martlet.sources.keyed import BUCKET, KeyedTable
from martlet.sources.tables import Tables

#: Order of arrival by feed: columns of the sort for orders, names of columns for merged feeds.
Arrival = dict[str, list]

# What the two histories record.
PRODUCT_HISTORY = {
    "key": "product_id",
    "tracked": ["price", "price_tier"],
    "carried": ["product_name", "category", "price", "price_tier"],
}
CUSTOMER_HISTORY = {
    "key": "customer_id",
    "tracked": ["loyalty_tier"],
    "carried": ["full_name", "email", "loyalty_tier", "total_lifetime_spend"],
}


def price_reason(old: str, new: str) -> Column:
    return labels.price_change_reason(*[F.col(f"{s}.{c}") for c in ("price", "price_tier") for s in (old, new)])


def tier_reason(old: str, new: str) -> Column:
    columns = ("loyalty_tier", "total_lifetime_spend")
    return labels.tier_change_reason(*[F.col(f"{s}.{c}") for c in columns for s in (old, new)])


def _insert_ignore(
    tables: Tables, table: str, key: list[str], feed: DataFrame, order: list[Column], run_id: str, record: list[str] | None = None
) -> int:
    """Append the records of ``feed`` whose key no other load has, and note their keys; returns the rows.

    The keys are kept in buckets beside the table, so a run reads those buckets that its own keys fall into, and no record. An index
    that lacks a load, as after a run that died before it had noted its keys, is built anew from the table. ``record``: the columns
    of the record as received, of which the appended rows keep the payload; those that are not appended need none.
    """
    number = sum(load != run_id for load in tables.loads(table))
    index = KeyedTable(tables.spark, f"{tables.root}/index/{table}", key)
    if not index.covers(number):
        index.rebuild(number, tables.read_appended(table, without_load=run_id).select(*key))
    new = index.new_rows(number, feed, order).drop(BUCKET)
    if record is not None:
        new = with_raw_json(new, record=record)
    rows = tables.append(table, new, run_id)
    index.store(number, tables.read_appended(table).filter(F.col("load_id") == run_id).select(*key))
    return rows


def _unread_loads(tables: Tables, bronze: str, clean: str, run_id: str) -> list[str]:
    """Loads that no earlier run has cleaned: one counts as cleaned once its run has stored what it rejects of them."""
    done = {r.removesuffix(f"-{clean}") for r in tables.loads("rejected_records") if r.endswith(f"-{clean}")}
    return [load for load in tables.loads(bronze) if load not in done or load == run_id]


def with_winners(tables: Tables, bronze: str, clean: str, state: str, run_id: str) -> DataFrame:
    """The new loads of a bronze table and, of all earlier ones, their winners: all that the clean step has to see."""
    columns = schemas.column_names(state)
    held = tables.read(state, run_id)
    loads = _unread_loads(tables, bronze, clean, run_id) if tables.exists(state, run_id) else tables.loads(bronze)
    new = tables.read_appended(bronze).filter(F.col("load_id").isin(loads))
    return held.select(*columns).unionByName(new.select(*columns))


def load_bronze(tables: Tables, feeds: dict[str, DataFrame], run_id: str, arrival: Arrival, at: dt.datetime) -> dict:
    """Products, orders and inventory are appended as one load per run; customers and campaigns merge.

    Orders need products and customers to refer to: loading them without either is an error.
    """
    # The payload of an order is longer than the order, so it is made of the rows that are appended, after they have moved.
    received = feeds["orders"].columns
    record = None if {"raw_json", BUCKET, *LINEAGE} & set(received) else received
    feeds = {
        name: bronze.stamped(name, feed, run_id, at, payload=name != "orders" or record is None) for name, feed in feeds.items()
    }
    counts = {}
    counts["bronze_products"] = _insert_ignore(
        tables, "bronze_products", bronze.PRODUCT_VERSION, feeds["products"], bronze.product_order(), run_id
    )
    stored = tables.read("bronze_customers", run_id)
    customers = bronze.merge_customers(stored, feeds["customers"], arrival["customers"], at)
    counts |= _merged(tables, "bronze_customers", stored, customers, run_id)
    for needed, rows in {"products": tables.read_appended("bronze_products"), "customers": tables.read("bronze_customers")}.items():
        if rows.limit(1).count() == 0:
            raise ValueError(f"orders cannot be loaded without {needed}")
    counts["bronze_orders"] = _insert_ignore(
        tables, "bronze_orders", ["order_id"], feeds["orders"], arrival["orders"], run_id, record
    )
    counts["bronze_inventory"] = tables.append("bronze_inventory", feeds["inventory"], run_id, ("inventory_date",))
    stored = tables.read("bronze_campaigns", run_id)
    campaigns = bronze.merge_campaigns(stored, feeds["campaigns"], arrival["campaigns"])
    return counts | _merged(tables, "bronze_campaigns", stored, campaigns, run_id)


def _merged(tables: Tables, table: str, before: DataFrame, after: DataFrame, run_id: str) -> dict:
    """Store a merged table; rows stored, and of these the rows that were not there before."""
    held = before.count()
    rows = tables.overwrite(table, after, run_id)
    return {table: rows, f"{table}_inserted": rows - held}


def merge_orders(tables: Tables, clean: DataFrame, run_id: str | None = None, at: dt.datetime | None = None) -> int:
    """Merge clean orders into the stored ones; returns the rows stored afterwards.

    Only months with a new order or another status are read in full and rewritten, and so are their roll-ups.
    The months are listed on the driver: one value per calendar month.
    """
    target = tables.read("silver_orders", run_id)
    if not tables.exists("silver_orders", run_id):
        rows = tables.overwrite("silver_orders", schemas.stamped(silver.with_month(clean), "silver_orders", at), run_id)
        update_cells(tables, None, run_id)
        return rows
    changed = pin(silver.changed_orders(target, clean))
    months = [r[0] for r in changed.select("order_month").distinct().collect()]
    if months:
        touched = target.filter(F.col("order_month").isin(months))
        tables.overwrite("silver_orders", silver.merge("silver_orders", touched, changed, at), run_id)
        update_cells(tables, months, run_id)
    dropped(tables.spark, changed.inputFiles())
    return tables.read("silver_orders").count()


def judged_orders(tables: Tables, customers: DataFrame, products: DataFrame, run_id: str) -> DataFrame:
    """Orders that no earlier run has judged, and those that waited for a customer or product, with the rules they break.

    Bronze orders never change, so a clean order stays clean and only these need a look. A load counts as judged
    once the clean step of its run has stored what it rejects. Stored, as it is written three times.
    """
    unseen = _unread_loads(tables, "bronze_orders", "silver_orders", run_id)
    columns = schemas.column_names("pending_orders")
    arrived = tables.read_appended("bronze_orders").filter(F.col("load_id").isin(unseen)).select(*columns)
    waiting = tables.read("pending_orders", run_id).join(arrived.select("order_id"), "order_id", "left_anti")
    return pin(silver.judged_orders(arrived.unionByName(waiting.select(*columns)), customers, products))


def build_silver(tables: Tables, as_of: dt.date, run_id: str, at: dt.datetime) -> dict:
    """Clean tables merge into what exists, except inventory, which is replaced."""
    customers = tables.read("bronze_customers")
    versions = with_winners(tables, "bronze_products", "silver_products", "product_winners", run_id)
    snapshots = with_winners(tables, "bronze_inventory", "silver_inventory", "inventory_winners", run_id)
    tables.overwrite("product_winners", silver.product_winners(versions), run_id)
    tables.overwrite("inventory_winners", silver.latest_inventory(snapshots), run_id)
    judged = judged_orders(tables, customers, tables.read("product_winners"), run_id)
    splits = {
        "silver_products": silver.silver_products(versions),
        "silver_customers": silver.silver_customers(customers, as_of, tables.read("silver_customers", run_id)),
        "silver_campaigns": silver.silver_campaigns(tables.read("bronze_campaigns"), as_of),
        "silver_orders": silver.split_orders(judged),
        "silver_inventory": silver.silver_inventory(snapshots),
    }
    counts = {"pending_orders": tables.overwrite("pending_orders", silver.pending_orders(judged), run_id)}
    for table, (clean, rejected) in splits.items():
        if table == "silver_orders":
            held = tables.read(table, run_id).count()
            counts[table] = merge_orders(tables, clean, run_id, at)
            counts[f"{table}_inserted"] = counts[table] - held
        elif table == "silver_inventory":
            counts[table] = tables.overwrite(table, schemas.stamped(clean, table, at), run_id)
        else:
            stored = tables.read(table, run_id)
            counts |= _merged(tables, table, stored, silver.merge(table, stored, clean, at), run_id)
        named = rejected.withColumn("table_name", F.lit(table))
        counts[f"{table}_rejected"] = tables.append("rejected_records", named, f"{run_id}-{table}")
    dropped(tables.spark, judged.inputFiles())
    return counts


def full_marts(tables: Tables, as_of: dt.date) -> dict[str, DataFrame]:
    """The five marts with all declared columns, from the stored clean tables and the roll-ups of the orders."""
    products, customers = tables.read("silver_products"), tables.read("silver_customers")
    campaigns, inventory = tables.read("silver_campaigns"), tables.read("silver_inventory")
    snapshots = tables.read_appended("bronze_inventory")
    newest = tables.read("inventory_winners") if tables.exists("inventory_winners") else silver.latest_inventory(snapshots)
    orders, visits, sales = (stored_cells(tables)[c] for c in ("order_cells", "customer_days", "product_days"))

    daily = gold.daily_revenue(visits).join(
        extended.daily_new_returning(visits).drop("unique_customers"), "revenue_date", "left"
    )
    performance = (
        gold.product_performance(products, orders, inventory, as_of)
        .join(extended.product_stock_stats(snapshots, sales, as_of), "product_id", "left")
        .join(extended.repeat_purchase_rate(orders).drop("buyers"), "product_id", "left")
        .join(
            extended.product_period_growth(sales, as_of).select("product_id", "revenue_growth_vs_previous"),
            "product_id",
            "left",
        )
    )
    segments = extended.segment_advice(gold.customer_rfm(customers, visits, as_of)).join(
        extended.next_purchase_days(visits, as_of), "customer_id", "left"
    )
    health = (
        gold.inventory_health(inventory, products, sales, as_of)
        .join(extended.inventory_cover(inventory, sales, as_of), "product_id", "left")
        .join(extended.reorder_advice(newest), "product_id", "left")
        .join(extended.stock_change(snapshots, newest), "product_id", "left")
    )
    roi = gold.campaign_roi(campaigns, sales, as_of).join(
        extended.campaign_acquisition(campaigns, sales, inventory, visits), "campaign_id", "left"
    )
    return {
        "gold_daily_revenue": daily,
        "gold_product_performance": performance,
        "gold_customer_segments": segments,
        "gold_inventory_health": health,
        "gold_campaign_roi": roi,
    }


def build_gold(tables: Tables, as_of: dt.date, at: dt.datetime) -> dict:
    marts = full_marts(tables, as_of)
    return {table: tables.overwrite(table, schemas.stamped(mart, table, at)) for table, mart in marts.items()}


def apply_snapshot(
    tables: Tables, table: str, snapshot: DataFrame, as_of: dt.date, surrogate: str, run_id: str | None = None, **spec
) -> int:
    """Bring a snapshot into a stored history; returns the rows stored afterwards.

    Histories are stored by the month in which a period ends. A run reads and rewrites
    the open periods and the month it closes periods in; older months stay untouched.
    """
    closing = (as_of - dt.timedelta(days=1)).replace(day=1)
    in_reach = F.col("closed_month").isin(closing, OPEN_END.replace(day=1))
    history = scd2_apply(
        tables.read(table, run_id).filter(in_reach), snapshot, as_of=as_of, surrogate=surrogate, **spec
    )
    tables.overwrite(table, history.withColumn("closed_month", F.trunc("valid_to", "month")), run_id)
    return tables.read(table).count()


def update_history(tables: Tables, as_of: dt.date, run_id: str, at: dt.datetime) -> dict:
    """Both histories; returns rows stored, and the new, changed and unchanged keys of each."""
    products = tables.read("silver_products").filter("is_active")
    customers = tables.read("silver_customers").filter("is_active")
    counts = {}
    for table, snapshot, surrogate, reason, spec in (
        ("product_price_history", products, "price_history_id", price_reason, PRODUCT_HISTORY),
        ("customer_tier_history", customers, "tier_history_id", tier_reason, CUSTOMER_HISTORY),
    ):
        changes = scd2_changes(tables.read(table, run_id), snapshot, spec["key"], spec["tracked"])
        counts |= {f"{table}_{r['action']}": r["n"] for r in changes.collect()}  # one row per action
        counts[table] = apply_snapshot(tables, table, snapshot, as_of, surrogate, run_id, reason=reason, at=at, **spec)
    return counts


def refresh(
    tables: Tables, feeds: dict[str, DataFrame], as_of: dt.date, run_id: str, arrival: Arrival
) -> dict[str, int]:
    """Run all layers; returns rows per table, and the inserted, rejected and changed ones.

    ``arrival`` tells the order in which the records of ``orders``, ``customers`` and ``campaigns`` arrived.
    """
    at = dt.datetime.combine(as_of, dt.time())
    return {
        **load_bronze(tables, feeds, run_id, arrival, at),
        **build_silver(tables, as_of, run_id, at),
        **build_gold(tables, as_of, at),
        **update_history(tables, as_of, run_id, at),
    }
