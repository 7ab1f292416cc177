"""The five marts. Every mart aggregates the orders before it joins them.

``orders`` are clean orders, or a roll-up of them (``cells``) that keeps the columns which the mart groups by.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions import labels
from martlet.functions.dates import day, in_last_days, weekday_parts
from martlet.functions.numeric import exact_avg, guarded, money, pct
from martlet.functions.ordering import SortKey
from martlet.operators.joins import interval_join, vs_previous_day
from martlet.operators.ranking import Rank, global_rank, tile_ends, tile_of, with_ranks
from martlet.plans.cells import as_cells, completed, total
from martlet.session import pin


def completed_since(orders: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Cells of completed orders of the last days; on stored tables this also selects month folders."""
    recent = completed(orders).filter(in_last_days(F.col("order_date"), as_of, days))
    if "order_month" not in orders.columns:
        return recent
    first = as_of - dt.timedelta(days=days)
    return recent.filter(F.col("order_month") >= day(first.replace(day=1)))


# ---------------------------------------------------------------- daily revenue


def daily_sums(orders: DataFrame, *more: Column) -> DataFrame:
    """What adds up over the orders of a day. Revenue counts completed orders, the other sums all."""
    # An order that is not completed adds nothing, a completed one without an amount is unknown.
    adds = (F.col("n_orders") > F.col("n_completed")) | (F.col("n_valued") > 0)
    return as_cells(orders).groupBy(F.col("order_date").alias("revenue_date")).agg(
        F.sum(F.when(adds, F.coalesce("revenue", F.lit(0)))).alias("_revenue"),
        total("revenue").alias("_completed_revenue"),
        total("n_valued").alias("_valued"),
        total("n_orders").alias("total_orders"),
        total("items").alias("total_items_sold"),
        total("n_completed").alias("completed_orders"),
        total("n_pending").alias("pending_orders"),
        total("n_cancelled").alias("cancelled_orders"),
        total("discount").alias("_discount"),
        total("n_coded").alias("orders_with_promo"),
        *more,
    )


def daily_parts(orders: DataFrame, first_visits: list[DataFrame]) -> DataFrame:
    """A part of the sums of each day; ``first_visits`` holds the pairs (day, customer) that no other part counts."""
    sums = daily_sums(orders)
    if not first_visits:
        return sums.withColumn("unique_customers", F.lit(0).cast("long"))
    new = first_visits[0].groupBy(F.col("order_date").alias("_day")).agg(F.count("*").alias("_new"))
    joined = sums.join(new, F.col("revenue_date").eqNullSafe(F.col("_day")), "left").drop("_day")
    return joined.withColumn("unique_customers", F.coalesce("_new", F.lit(0))).drop("_new")


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row for each day, in the types of the parts."""
    types = {f.name: f.dataType for f in parts.schema.fields}
    measures = [c for c in types if c not in ("revenue_date", "key_bucket")]
    keys = [c for c in ("revenue_date", "key_bucket") if c in types]
    return parts.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in measures])


def daily_measures(sums: DataFrame) -> DataFrame:
    """The columns of the mart from the sums of each day."""
    date = F.col("revenue_date")
    return sums.select(
        date,
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.quarter(date).alias("quarter"),
        *[c.alias(n) for n, c in weekday_parts(date, "day_of_week", "is_weekend").items()],
        money(F.col("_revenue")).alias("total_revenue"),
        "total_orders",
        "total_items_sold",
        exact_avg(F.col("_completed_revenue"), F.col("_valued")).alias("average_order_value"),
        "completed_orders",
        "pending_orders",
        "cancelled_orders",
        pct(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate"),
        "unique_customers",
        money(F.col("_discount")).alias("total_discount_given"),
        "orders_with_promo",
        pct(F.col("orders_with_promo"), F.col("total_orders")).alias("promo_usage_rate"),
    )


def daily_totals(orders: DataFrame) -> DataFrame:
    """One row per order date."""
    return daily_measures(daily_sums(orders, F.countDistinct("customer_id").alias("unique_customers")))


def with_growth(daily: DataFrame) -> DataFrame:
    change = F.col("total_revenue") - F.col("previous_value")
    return (
        vs_previous_day(daily, "revenue_date", "total_revenue")
        .withColumn("revenue_vs_previous_day", money(change))
        .withColumn("revenue_growth_pct", pct(change, F.col("previous_value")))
        .drop("previous_value")
    )


def daily_revenue(orders: DataFrame) -> DataFrame:
    return with_growth(daily_totals(orders))


# ---------------------------------------------------------------- products


def product_sales(orders: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    """Completed sales per product since ``as_of - days``."""
    return completed_since(orders, as_of, days).groupBy("product_id").agg(
        total("units").alias("units"),
        total("revenue").alias("revenue"),
        total("listed").alias("listed_value"),
        F.countDistinct("customer_id").alias("buyers"),
    )


def product_totals(
    products: DataFrame, orders: DataFrame, inventory: DataFrame, as_of: dt.date, days: int = 30
) -> DataFrame:
    """Product performance without ranks. The cost is constant per product, so profit
    needs only the summed units; an unknown cost leaves the margin NULL and the profit 0."""
    profit = F.col("listed_value") - F.col("cost_price") * F.col("units")
    return (
        products.select("product_id", "product_name", "category", "price", "average_rating")
        .join(product_sales(orders, as_of, days), "product_id", "left")
        .join(inventory.select("product_id", "cost_price"), "product_id", "left")
        .select(
            "product_id",
            F.lit(f"last_{days}_days").alias("analysis_period"),
            day(as_of - dt.timedelta(days=days)).alias("period_start_date"),
            day(as_of).alias("period_end_date"),
            "product_name",
            "category",
            F.col("price").alias("current_price"),
            F.coalesce("units", F.lit(0)).alias("units_sold"),
            money(F.coalesce("revenue", F.lit(0))).alias("total_revenue"),
            money(F.coalesce(profit, F.lit(0))).alias("total_profit"),
            F.when(F.col("revenue") > 0, pct(profit, F.col("revenue")))
            .otherwise(money(F.lit(0)))
            .alias("profit_margin"),
            F.coalesce("buyers", F.lit(0)).alias("unique_customers"),
            "average_rating",
        )
    )


def product_performance(
    products: DataFrame,
    orders: DataFrame,
    inventory: DataFrame,
    as_of: dt.date,
    days: int = 30,
) -> DataFrame:
    by_revenue = SortKey("total_revenue", descending=True)
    ranks = [Rank([], by_revenue, "overall_rank"), Rank(["category"], by_revenue, "category_rank")]
    return with_ranks(product_totals(products, orders, inventory, as_of, days), ranks, "product_id")


# ---------------------------------------------------------------- customers


def customer_order_totals(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer with totals over completed orders; no orders gives a zero count and NULL sums."""
    per_customer = completed(orders).groupBy("customer_id").agg(
        total("n_completed").alias("_orders"),
        total("revenue").alias("_value"),
        total("n_valued").alias("_valued"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return (
        customers.select("customer_id", "full_name", "email", "signup_date")
        .join(per_customer, "customer_id", "left")
        .select(
            "customer_id",
            "full_name",
            "email",
            "signup_date",
            F.coalesce("_orders", F.lit(0)).alias("total_orders"),
            money(F.col("_value")).alias("total_lifetime_value"),
            exact_avg(F.col("_value"), F.col("_valued")).alias("average_order_value"),
            "first_order_date",
            "last_order_date",
        )
    )


def rfm_scores(
    customers: DataFrame,
    orders: DataFrame,
    as_of: dt.date,
    k: int = 5,
    score_direction: str = "reference",
) -> DataFrame:
    """Customer totals with three tile scores.

    By default tile 1 holds the most recent, most frequent and highest-spending
    customers; ``score_direction='conventional'`` gives those the score ``k``.
    """
    if score_direction not in ("reference", "conventional"):
        raise ValueError(f"unknown score direction {score_direction!r}")
    base = customer_order_totals(customers, orders).withColumn(
        "days_since_last_order", F.datediff(day(as_of), "last_order_date")
    )
    scores = {
        "recency_score": SortKey("days_since_last_order"),
        "frequency_score": SortKey("total_orders", descending=True),
        "monetary_score": SortKey("total_lifetime_value", descending=True),
    }
    base = pin(base)  # sorted three times and labelled once
    tiles = {
        out: tile_of(order, "customer_id", tile_ends(base, k, order, "customer_id")) for out, order in scores.items()
    }
    base = base.withColumns(tiles)
    if score_direction == "conventional":
        base = base.withColumns({out: (F.lit(k + 1) - F.col(out)).cast("int") for out in scores})
    return base


def customer_rfm(customers: DataFrame, orders: DataFrame, as_of: dt.date, k: int = 5, **options) -> DataFrame:
    r, f, m = (F.col(c) for c in ("recency_score", "frequency_score", "monetary_score"))
    days_since = F.coalesce("days_since_last_order", F.lit(labels.NEVER_ORDERED_DAYS))
    return rfm_scores(customers, orders, as_of, k, **options).select(
        "customer_id",
        "full_name",
        "email",
        "signup_date",
        r,
        f,
        m,
        F.concat(r, f, m).alias("rfm_combined_score"),
        days_since.alias("days_since_last_order"),
        "total_orders",
        F.coalesce("total_lifetime_value", money(F.lit(0))).alias("total_lifetime_value"),
        F.coalesce("average_order_value", money(F.lit(0))).alias("average_order_value"),
        labels.rfm_segment(r, f, m, F.col("total_orders")).alias("customer_segment"),
        labels.churn_risk(days_since).alias("churn_risk"),
        "first_order_date",
        "last_order_date",
    )


# ---------------------------------------------------------------- inventory


def sold_products(orders: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return completed_since(orders, as_of, days).select("product_id").distinct()


def dead_stock(inventory: DataFrame, orders: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Products in stock without a completed order in the period."""
    return inventory.filter("stock_quantity > 0").join(sold_products(orders, as_of, days), "product_id", "left_anti")


def inventory_health(
    inventory: DataFrame, products: DataFrame, orders: DataFrame, as_of: dt.date, days: int = 30
) -> DataFrame:
    sold = sold_products(orders, as_of, days).withColumn("_sold", F.lit(True))
    return (
        inventory.join(products.select("product_id", "product_name", "category", "price"), "product_id")
        .join(sold, "product_id", "left")
        .select(
            F.col("inventory_date").alias("snapshot_date"),
            "product_id",
            "product_name",
            "category",
            F.col("stock_quantity").alias("current_stock"),
            "stock_status",
            "warehouse_location",
            "inventory_value",
            "cost_price",
            F.col("price").alias("selling_price"),
            money((F.col("price") - F.col("cost_price")) * F.col("stock_quantity")).alias("potential_profit"),
            (F.col("stock_status") == "Low Stock").alias("is_low_stock"),
            (F.col("stock_status") == "Overstock").alias("is_overstock"),
            (F.col("_sold").isNull() & (F.col("stock_quantity") > 0)).alias("is_dead_stock"),
        )
    )


# ---------------------------------------------------------------- campaigns


def promo_days(orders: DataFrame) -> DataFrame:
    """Completed orders per promotion code and day: one small row per join key."""
    return (
        completed(orders)
        .filter(F.col("promo_code").isNotNull())
        .groupBy("promo_code", "order_date")
        .agg(total("n_completed").alias("n_orders"), total("revenue").alias("revenue"))
    )


def campaign_days(campaigns: DataFrame, orders: DataFrame, how: str = "inner") -> DataFrame:
    """Each campaign with the days its code was used while it ran; overlaps count for each campaign."""
    frame = campaigns.select("campaign_id", "promo_code", "start_date", "end_date")
    return interval_join(
        promo_days(orders), frame, "promo_code", "order_date", "start_date", "end_date", how, "dyadic", "campaign_id"
    )


def campaign_totals(campaigns: DataFrame, orders: DataFrame) -> DataFrame:
    spend, revenue, n = F.col("actual_spend"), F.col("_revenue"), F.col("total_orders")
    matched = campaign_days(campaigns, orders).groupBy("campaign_id").agg(
        F.sum("n_orders").alias("_orders"), F.sum("revenue").alias("_revenue")
    )
    zero = money(F.lit(0))
    return (
        campaigns.join(matched, "campaign_id", "left")
        .withColumn("total_orders", F.coalesce("_orders", F.lit(0)))
        .select(
            "campaign_id", "campaign_name", "channel", "promo_code", "start_date", "end_date", "budget", "actual_spend",
            "total_orders",
            money(F.coalesce(revenue, F.lit(0))).alias("total_revenue"),
            n.alias("promo_code_usage_count"),
            F.when(spend > 0, pct(revenue - spend, spend)).otherwise(zero).alias("roi"),
            F.when(spend > 0, money(F.round(guarded(revenue, spend), 2))).otherwise(zero).alias("roas"),
            F.when(n > 0, exact_avg(spend, n)).otherwise(zero).alias("cost_per_order"),
        )
    )


def campaign_roi(campaigns: DataFrame, orders: DataFrame, as_of: dt.date) -> DataFrame:
    """An unknown return rates lowest, yet ranks first: NULL sorts as the largest value."""
    totals = campaign_totals(campaigns, orders).select(
        "*",
        labels.performance_rating(F.col("roi")).alias("performance_rating"),
        labels.campaign_status(F.col("end_date"), day(as_of)).alias("campaign_status"),
    )
    return global_rank(totals, SortKey("roi", descending=True), "campaign_id", "campaign_rank")
