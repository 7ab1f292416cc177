"""What the daily run, the as-of join and text feeds move and write, seen in their plans and files."""

import gzip

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from martlet import queries as registry
from martlet.operators.history import scd2_as_of
from martlet.plans import bronze, cells, silver
from martlet.plans import refresh as refresh_module
from martlet.queries import Lake, _stored
from martlet.session import stored
from martlet.sources import feeds, star
from martlet.sources.keyed import KeyedTable
from martlet.sources.star import AS_OF, midnight
from martlet.sources.tables import Tables


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SMALL)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payload_is_made_of_appended_orders(lake, tmp_path, monkeypatch):
    """Neither the payload nor known orders take part in the search for the first record of an order, and nothing is kept on the way."""
    received, plans = lake.order_feed, []
    append = Tables.append

    def seen(self, table, df, *more):
        plans.append(plan_of(df))
        return append(self, table, df, *more)

    monkeypatch.setattr(Tables, "append", seen)
    tables = Tables(lake.spark, str(tmp_path))
    feed = bronze.stamped("orders", received, "one", midnight(AS_OF), payload=False)
    for run_id in ("one", "two"):
        refresh_module._insert_ignore(tables, "bronze_orders", ["order_id"], feed, star.order_arrival(), run_id, received.columns)
    for plan in plans:
        assert "InMemoryTableScan" not in plan and "raw_json" in plan and "raw_json" not in plan[plan.index("Window") :]
    assert plans[1].index("Window") < plans[1].index("LeftAnti")
    kept = tables.read_appended("bronze_orders").select("order_id", "raw_json")
    made = feeds.with_raw_json(received).select("order_id", "raw_json")
    assert kept.count() == kept.select("order_id").distinct().count() == received.select("order_id").distinct().count()
    assert kept.join(made, ["order_id", "raw_json"], "left_anti").count() == 0


@pytest.mark.parametrize("column", ["source", "raw_json", "ingestion_timestamp"])
def test_payload_keeps_what_the_feed_brings(lake, tmp_path, column):
    """Columns that the run would overwrite are in the payload as they came."""
    value = F.lit(None).cast("string") if column == "raw_json" else F.lit("2000-01-01")
    received = lake.order_feed.limit(20).withColumn(column, value)
    given = {"products": star.product_feed(lake.spark, lake.sf, 1), "customers": star.customer_feed(lake.spark, lake.sf),
             "orders": received, "inventory": lake.inventory, "campaigns": star.campaign_feed(lake.spark, lake.sf)}
    tables = Tables(lake.spark, str(tmp_path))
    arrival = {"orders": star.order_arrival(), "customers": ["signup_date"], "campaigns": ["campaign_name"]}
    refresh_module.load_bronze(tables, given, "one", arrival, midnight(AS_OF))
    texts = [r[0] for r in tables.read_appended("bronze_orders").select("raw_json").collect()]
    assert texts and all((t is None) if column == "raw_json" else (f'"{column}":"2000-01-01"' in t) for t in texts)


def test_insert_ignore_with_null_keys(spark, tmp_path):
    """A null key is a key: its first record counts, for ever."""
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=4)
    schema = "k int, note string"
    table.insert_ignore(0, spark.createDataFrame([(None, "b"), (None, "a"), (1, "a")], schema), [F.col("note")])
    table.insert_ignore(1, spark.createDataFrame([(None, "c"), (1, "0"), (2, "z"), (2, "y")], schema), [F.col("note")])
    assert sorted(map(tuple, table.read().select("k", "note").collect()), key=repr) == [(1, "a"), (2, "y"), (None, "a")]


def test_judged_orders_are_read_from_files(lake):
    """Every reader of the judged orders takes its own columns from packed files."""
    judged = stored(silver.judged_orders(lake.orders, lake.customer_keys, lake.products), "judged-orders")
    waiting = plan_of(silver.split_orders(judged)[1])
    assert "FileScan parquet" in waiting and "ExistingRDD" not in waiting
    assert "shipping_address" not in waiting and "final_amount" not in waiting


def test_order_cells_take_one_exchange(lake, tmp_path, monkeypatch):
    tables, plans = _stored(lake, "one-exchange"), {}
    write = Tables._write

    def seen(self, table, df, target, by, placed=False):
        if table == "order_cells":
            plans[table] = plan_of(df) if placed else plan_of(df.hint("rebalance", *by))
        return write(self, table, df, target, by, placed)

    monkeypatch.setattr(Tables, "_write", seen)
    cells.update_cells(tables, None)
    assert plans["order_cells"].count("Exchange") == 1 and "rangepartitioning" in plans["order_cells"]
    assert tables.read("order_cells").agg(F.sum("n_orders")).first()[0] == lake.clean_orders.count()


def test_as_of_reads_its_facts_once(spark, lake):
    """Undated facts come from what was stored of all facts; their source is not read again."""
    fact = lake.clean_orders.select(
        "order_id", F.when(F.col("quantity") > 2, F.col("customer_id")).alias("customer_id"), F.when(F.col("quantity") < 40, F.col("order_date")).alias("order_date")
    )
    history = lake.tier_history.select("customer_id", "loyalty_tier", "valid_from", "valid_to")
    found = scd2_as_of(history, fact, "customer_id", "order_date")
    assert all("/as-of-" in f for f in found.inputFiles())
    assert found.count() == fact.count()
    lost = found.filter("customer_id is null or order_date is null")
    assert lost.filter("loyalty_tier is not null").count() == 0
    assert lost.exceptAll(lost.limit(0)).count() == fact.filter("customer_id is null or order_date is null").count() > 0


@pytest.mark.parametrize("name, fmt", [("orders", "json"), ("customers", "csv")])
def test_text_feeds_travel_packed_in_bounded_files(lake, monkeypatch, name, fmt):
    monkeypatch.setattr(registry, "FEED_FILE_RECORDS", 100)
    made = lake.orders.drop("l_returnflag", *star.ORDER_ARRIVAL) if name == "orders" else star.customer_feed(lake.spark, lake.sf)
    read = registry._delivered(lake, name, made, fmt)
    files = [f.removeprefix("file://") for f in read.inputFiles()]
    assert all(f.endswith(f".{fmt}.gz") for f in files) and len(files) >= made.count() / 100
    for f in files[:3]:
        with gzip.open(f, "rt") as lines:
            assert 0 < sum(1 for _ in lines) <= 101
    assert read.count() == made.count()
