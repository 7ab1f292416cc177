"""What the physical plans must and must not contain, with automatic broadcasting off."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from martlet import schemas
from martlet.operators import ranking
from martlet.plans import gold
from martlet.queries import QUERIES, Lake
from martlet.session import pin
from martlet.sources.star import AS_OF


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


WRITERS = {
    "inventory_append", "products_full_refresh", "mart_row_counts", "orders_incremental", "stream_daily_revenue",
    "customers_incremental", "product_feed_json", "customer_feed_csv", "order_feed_json", "inventory_feed_csv",
    "campaign_feed_orc", "user_feed_json", "refresh_silver_customers", "refresh_silver_orders", "refresh_price_history",
    "refresh_counts", "unique_customers_by_period", "feed_rescued_lines",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_rows_and_no_pairwise_joins(no_broadcast, name):
    text = plan(QUERIES[name](Lake(no_broadcast, SMALL)))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


@pytest.mark.parametrize(
    "name",
    ["daily_revenue", "product_performance", "customer_rfm", "campaign_roi", "customer_segment_counts", "churn_risk", "rfm_scores"],
)
def test_no_single_task(no_broadcast, monkeypatch, name):
    """Neither in what is pinned on the way nor in what is left."""
    plans = []

    def spy(df):
        plans.append(plan(df))
        return pin(df)

    for module in (gold, ranking):
        monkeypatch.setattr(module, "pin", spy)
    plans.append(plan(QUERIES[name](Lake(no_broadcast, SMALL))))
    assert len(plans) > 1 or name == "daily_revenue"
    for text in plans:
        assert "SinglePartition" not in text and "rank(" not in text and "ntile(" not in text


@pytest.mark.parametrize("name", ["dq_orders_referential", "dq_order_rejects"])
def test_orders_are_judged_in_one_pass(no_broadcast, name):
    assert plan(QUERIES[name](Lake(no_broadcast, SMALL))).count("l_orderkey#") > 0
    text = QUERIES[name](Lake(no_broadcast, SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("l_orderkey#") and sum("l_partkey" in line and "Relation" in line for line in text.splitlines()) == 1


def test_latest_rows_are_limited_before_the_exchange(no_broadcast):
    text = plan(QUERIES["latest_inventory"](Lake(no_broadcast, SMALL)))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_marts_over_stored_orders_prune_and_push_down(spark, tmp_path):
    Lake(spark, SMALL).clean_orders.write.parquet(str(tmp_path / "o"))
    orders = spark.read.schema(schemas.struct_type("silver_orders")).parquet(str(tmp_path / "o"))
    text = plan(gold.product_sales(orders, AS_OF, 30))
    assert "EqualTo(status,completed)" in text and "GreaterThanOrEqual(order_date,2001-07-02)" in text
    scan = [line for line in text.splitlines() if "FileScan" in line][0]
    assert "payment_method" not in scan and "order_time" not in scan


def test_orders_are_aggregated_before_they_meet_campaigns(no_broadcast):
    x = Lake(no_broadcast, SMALL)
    text = plan(gold.campaign_totals(x.clean_campaigns, x.clean_orders))
    assert "SortMergeJoin [promo_code" in text
    assert text.index("SortMergeJoin [promo_code") < text.index("hashpartitioning(promo_code")


def test_hot_key_gives_the_same_answer(spark):
    """A third of all orders on one day, product, customer and code."""
    n = 6000
    hot = F.col("id") % 3 == 0
    orders = spark.range(n).select(
        F.concat(F.lit("o"), "id").alias("order_id"),
        F.when(hot, "c0").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("customer_id"),
        F.when(hot, 0).otherwise(F.col("id") % 40).cast("int").alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(2).cast("decimal(10,2)").alias("unit_price"),
        F.lit(0).cast("decimal(10,2)").alias("discount_amount"),
        F.lit(2).cast("decimal(10,2)").alias("final_amount"),
        F.date_add(F.lit("2001-07-20").cast("date"), F.when(hot, 0).otherwise(F.col("id") % 10).cast("int")).alias(
            "order_date"
        ),
        F.lit("completed").alias("status"),
        F.lit("X").alias("promo_code"),
    )
    daily = {str(r["revenue_date"]): r for r in gold.daily_revenue(orders).collect()}
    assert sum(r["total_orders"] for r in daily.values()) == n
    assert daily["2001-07-20"]["total_orders"] >= n // 3
    campaigns = spark.sql(
        "SELECT 'a' campaign_id, 'n' campaign_name, 'Email' channel, 'X' promo_code, DATE'2001-07-20' start_date, "
        "DATE'2001-07-29' end_date, 1.0BD budget, CAST(10 AS DECIMAL(12,2)) actual_spend"
    )
    assert gold.campaign_totals(campaigns, orders).first()["total_orders"] == n
