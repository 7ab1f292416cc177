"""Declared mart measures with definitions of our own, see the README.

As in ``gold``, ``orders`` are clean orders or a roll-up of them that keeps the columns which the measure groups by.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.dates import day, in_last_days
from martlet.functions.numeric import exact_avg, guarded, money, pct
from martlet.operators.joins import interval_join
from martlet.plans.cells import as_cells, completed, total
from martlet.plans.gold import completed_since

SEGMENT_ADVICE = [
    ("Champions", "High in all three scores", "Offer early access and referral rewards"),
    ("Loyal Customers", "Upper range in all three scores", "Offer a loyalty upgrade"),
    ("Potential Loyalists", "High recency score, low frequency score", "Suggest a membership or a bundle"),
    ("At Risk", "Low recency score, higher frequency score", "Send a personal win-back offer"),
    ("Lost", "Low recency and frequency scores", "Run a low-cost reactivation campaign"),
    ("New (No Orders)", "Signed up, no completed order", "Send a first-purchase incentive"),
    ("Regular", "Everyone else", "Keep informed about new products"),
]


def daily_new_returning(orders: DataFrame) -> DataFrame:
    """Customers per day, split by whether it is their first order date."""
    visits = orders.groupBy("order_date", "customer_id").agg(F.lit(1).alias("_v"))
    per_day = visits.groupBy(F.col("order_date").alias("revenue_date")).agg(F.count("*").alias("unique_customers"))
    first_days = (
        visits.groupBy("customer_id").agg(F.min("order_date").alias("revenue_date"))
        .groupBy("revenue_date").agg(F.count("*").alias("new_customers"))
    )
    new = F.coalesce("new_customers", F.lit(0))
    return per_day.join(first_days, "revenue_date", "left").select(
        "revenue_date", "unique_customers", new.alias("new_customers"),
        (F.col("unique_customers") - new).alias("returning_customers"),
    )


def units_sold(orders: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return completed_since(orders, as_of, days).groupBy("product_id").agg(total("units").alias("units"))


def product_stock_stats(snapshots: DataFrame, orders: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Mean stock, days without stock and turnover from the snapshots of the period."""
    period = snapshots.filter("stock_quantity >= 0").filter(in_last_days(F.col("inventory_date"), as_of, days))
    stats = period.groupBy("product_id").agg(
        F.sum("stock_quantity").alias("_stock"),
        F.count("*").alias("_n"),
        F.countDistinct(F.when(F.col("stock_quantity") == 0, F.col("inventory_date"))).alias("stockout_days"),
    )
    dec = "decimal(20,0)"
    stock, n = F.col("_stock").cast(dec), F.col("_n").cast(dec)
    units = F.coalesce("units", F.lit(0)).cast(dec)
    return stats.join(units_sold(orders, as_of, days), "product_id", "left").select(
        "product_id",
        F.round(stock / n, 0).cast("int").alias("avg_stock_level"),
        "stockout_days",
        money(F.round(guarded(units * n, stock), 2)).alias("inventory_turnover"),
    )


def repeat_purchase_rate(orders: DataFrame) -> DataFrame:
    """Share of the buyers of a product with two or more completed orders of it."""
    pairs = completed(orders).groupBy("product_id", "customer_id").agg(total("n_completed").alias("n"))
    return pairs.groupBy("product_id").agg(
        F.count("*").alias("buyers"),
        pct(F.count(F.when(F.col("n") >= 2, 1)), F.count("*")).alias("repeat_purchase_rate"),
    )


def product_period_growth(orders: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Revenue of the period against the period before it."""
    recent = in_last_days(F.col("order_date"), as_of, days)
    sums = (
        completed_since(orders, as_of, 2 * days)
        .groupBy("product_id")
        .agg(
            F.sum(F.when(recent, F.col("revenue")).otherwise(0)).cast("decimal(20,2)").alias("current"),
            F.sum(F.when(~recent, F.col("revenue")).otherwise(0)).cast("decimal(20,2)").alias("previous"),
        )
    )
    return sums.select(
        "product_id",
        money(F.col("current")).alias("current_revenue"),
        money(F.col("previous")).alias("previous_revenue"),
        pct(F.col("current") - F.col("previous"), F.col("previous")).alias("revenue_growth_vs_previous"),
    )


def segment_advice(segments: DataFrame) -> DataFrame:
    """Description and recommended action; the label table has seven rows."""
    spark = segments.sparkSession
    advice = spark.createDataFrame(
        SEGMENT_ADVICE, "customer_segment string, segment_description string, recommended_action string"
    )
    return segments.join(F.broadcast(advice), "customer_segment", "left")


def next_purchase_days(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Mean gap between order days minus the days since the last one, at least 0."""
    dates = completed(orders).groupBy("customer_id", "order_date").agg(F.lit(1).alias("_v"))
    per = dates.groupBy("customer_id").agg(
        F.min("order_date").alias("first"), F.max("order_date").alias("last"), F.count("*").alias("n")
    )
    gap = F.round(
        guarded(F.datediff("last", "first").cast("decimal(10,0)"), (F.col("n") - 1).cast("decimal(10,0)")), 0
    )
    left = gap.cast("int") - F.datediff(day(as_of), "last")
    return per.select(
        "customer_id",
        F.when(gap.isNotNull(), F.greatest(left, F.lit(0))).alias("predicted_next_purchase_days"),
    )


def inventory_cover(inventory: DataFrame, orders: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Daily sales, days of stock left and turnover of the current stock."""
    units = F.coalesce("units", F.lit(0)).cast("decimal(20,0)")
    stock = F.col("stock_quantity").cast("decimal(20,0)")
    return inventory.join(units_sold(orders, as_of, days), "product_id", "left").select(
        "product_id",
        exact_avg(units, F.lit(days).cast("decimal(10,0)")).alias("avg_daily_sales"),
        F.floor(guarded(stock * days, units)).cast("int").alias("days_of_inventory_remaining"),
        money(F.round(guarded(units * F.col("cost_price"), F.col("inventory_value")), 2)).alias(
            "inventory_turnover_rate"
        ),
    )


def reorder_advice(latest: DataFrame) -> DataFrame:
    """``latest``: newest bronze snapshot per product, which still has the reorder quantity."""
    due = F.col("stock_quantity") <= F.col("reorder_point")
    return latest.select(
        "product_id",
        due.alias("reorder_recommended"),
        F.when(due, F.col("reorder_quantity")).otherwise(0).alias("recommended_reorder_quantity"),
    )


def stock_change(snapshots: DataFrame, latest: DataFrame, days: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Current stock minus the newest snapshot at least ``d`` days older."""
    now = latest.select(
        F.col("product_id"), F.col("stock_quantity").alias("_now"), F.col("inventory_date").alias("_date")
    )
    seen = snapshots.filter("stock_quantity >= 0").select("product_id", "stock_quantity", "inventory_date")
    earlier = {
        d: F.max_by(
            "stock_quantity",
            F.when(F.col("inventory_date") <= F.date_sub("_date", d), F.struct("inventory_date", "stock_quantity")),
        )
        for d in days
    }
    return (
        seen.join(now, "product_id")
        .groupBy("product_id")
        .agg(*[(F.max("_now") - e).alias(f"stock_change_{d}days") for d, e in earlier.items()])
    )


def campaign_acquisition(
    campaigns: DataFrame, orders: DataFrame, inventory: DataFrame, visits: DataFrame | None = None
) -> DataFrame:
    """Profit, first-time customers, cost per acquisition and conversion per campaign.

    ``visits`` are orders by customer and day, from which the first order of each is taken, if ``orders`` are a roll-up without customers.
    """
    coded = as_cells(orders).filter(F.col("promo_code").isNotNull())
    per_product = coded.groupBy("promo_code", "order_date", "product_id").agg(
        total("n_orders").alias("_all"),
        total("n_completed").alias("_completed"),
        total("revenue").alias("_revenue"),
        total("units").alias("_units"),
    )
    profit = F.col("_revenue") - F.col("cost_price") * F.col("_units")
    per_day = (
        per_product.join(inventory.select("product_id", "cost_price"), "product_id", "left")
        .groupBy("promo_code", "order_date")
        .agg(
            F.sum("_all").alias("matched"), F.sum("_completed").alias("completed"), F.sum(profit).alias("profit"),
            F.lit(0).cast("long").alias("acquired"),
        )
    )
    firsts = (
        completed(orders if visits is None else visits).groupBy("customer_id")
        .agg(F.min_by(F.struct("promo_code", "order_date"), F.struct("first_timestamp", "first_order_id")).alias("f"))
        .filter(F.col("f.promo_code").isNotNull())
        .groupBy(F.col("f.promo_code").alias("promo_code"), F.col("f.order_date").alias("order_date"))
        .agg(F.count("*").alias("acquired"))
    )
    zero = {"matched": "long", "completed": "long", "profit": "decimal(38,2)"}
    measures = per_day.withColumn("profit", F.col("profit").cast("decimal(38,2)")).unionByName(
        firsts.withColumns({n: F.lit(None).cast(t) for n, t in zero.items()})
    )
    frame = campaigns.select("campaign_id", "promo_code", "start_date", "end_date")
    totals = (
        interval_join(measures, frame, "promo_code", "order_date", "start_date", "end_date", step="dyadic")
        .groupBy("campaign_id")
        .agg(*[F.sum(c).alias(c) for c in ("matched", "completed", "profit", "acquired")])
    )
    acquired = F.coalesce("acquired", F.lit(0))
    return campaigns.join(totals, "campaign_id", "left").select(
        "campaign_id",
        money(F.coalesce("profit", F.lit(0))).alias("total_profit"),
        acquired.alias("new_customers_acquired"),
        exact_avg(F.col("actual_spend"), acquired).alias("cost_per_acquisition"),
        pct(F.col("completed"), F.col("matched")).alias("conversion_rate"),
    )


def revenue_yoy(daily: DataFrame) -> DataFrame:
    """Daily revenue beside the same calendar day one year earlier."""
    base = daily.select("revenue_date", "total_revenue")
    earlier = base.select(F.col("revenue_date").alias("_then"), F.col("total_revenue").alias("revenue_last_year"))
    change = F.col("total_revenue") - F.col("revenue_last_year")
    return base.join(earlier, F.add_months("revenue_date", -12) == F.col("_then"), "left").select(
        "revenue_date", "total_revenue", "revenue_last_year",
        pct(change, F.col("revenue_last_year")).alias("revenue_yoy_pct"),
    )


def weekend_pattern(orders: DataFrame) -> DataFrame:
    done = orders.filter(F.col("status") == "completed")
    return done.groupBy("is_weekend").agg(
        F.count("*").alias("completed_orders"),
        money(F.sum("final_amount")).alias("total_revenue"),
        exact_avg(F.sum("final_amount"), F.count("final_amount")).alias("average_order_value"),
        F.countDistinct("order_date").alias("n_days"),
    )
