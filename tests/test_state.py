"""What is kept between runs and batches: as-of joins, bitmaps of customers, winners and key indexes."""

import bisect
import datetime as dt
import random

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from martlet.operators.history import scd2_as_of
from martlet.plans import refresh as refresh_module
from martlet.plans import silver, visitors
from martlet.plans.refresh import refresh, with_winners
from martlet.queries import Lake
from martlet.sources import star
from martlet.sources.keyed import KeyedTable
from martlet.sources.tables import Tables

DAY = dt.date(2001, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


# ---------------------------------------------------------------- as-of join


def versions_of(spark, periods):
    rows = [(k, f"{k}@{a}", day(a), day(b)) for k, a, b in periods]
    return spark.createDataFrame(rows, "k int, name string, valid_from date, valid_to date")


def plain(periods, k, at):
    fits = [a for key, a, b in periods if key == k and at is not None and a <= at <= b]
    return f"{k}@{max(fits)}" if fits else None


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_as_of_equals_plain_search(spark, partitions):
    """Gaps, empty periods, keys without versions, facts before all versions, at both ends, repeated, without key or day."""
    rng, periods = random.Random(partitions), []
    for k in range(6):
        at = rng.randrange(5)
        for _ in range(rng.choice([1, 4, 30])):
            length = rng.choice([1, 2, 9])
            periods.append((k, at, at + length - 1))
            if rng.random() < 0.3:
                periods.append((k, at + length, at + length - 1))  # empty
            at += length + (rng.random() < 0.2) * 3
    facts = [(i, rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 9, None]), rng.choice([None, *range(120)])) for i in range(600)]
    fact = spark.createDataFrame([(i, k, None if t is None else day(t)) for i, k, t in facts], "i int, k int, seen date")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        left = scd2_as_of(versions_of(spark, periods), fact, "k", "seen").collect()
        inner = scd2_as_of(versions_of(spark, periods), fact, "k", "seen", "inner").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = {i: plain(periods, k, t) for i, k, t in facts}
    assert len(left) == 600 and {r["i"]: r["name"] for r in left} == expected
    assert {r["i"]: r["name"] for r in inner} == {i: n for i, n in expected.items() if n} and len(inner) == len({r["i"] for r in inner})


def test_ten_thousand_versions_of_one_key(spark):
    """Each fact meets one version; no operator of the plan makes more rows than there are facts and versions."""
    n = 10_000
    versions = spark.range(n).select(
        F.lit(1).alias("k"), F.col("id").alias("price"),
        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("valid_from"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("valid_to"),
    )
    fact = spark.range(3 * n).select(F.lit(1).alias("k"), F.col("id"), F.date_add(F.lit(DAY), (F.col("id") % n).cast("int")).alias("at"))
    found = scd2_as_of(versions, fact, "k", "at")
    assert found.filter(F.col("price") == F.col("id") % n).count() == 3 * n == found.count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = scd2_as_of(versions, fact, "k", "at")._jdf.queryExecution()
        execution.toRdd().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    pending, made = [execution.executedPlan()], []
    while pending:
        node = pending.pop()
        if node.metrics().contains("numOutputRows"):
            made.append(node.metrics().apply("numOutputRows").value())
        pending += [node.children().apply(i) for i in range(node.children().size())]
    assert 3 * n <= max(made) <= 4 * n


# ---------------------------------------------------------------- bitmaps


def test_customers_of_any_period(spark):
    rng = random.Random(3)
    rows = [(day(rng.randrange(200)), None if rng.random() < 0.05 else f"c{rng.randrange(90_000)}") for _ in range(60_000)]
    orders = spark.createDataFrame(rows, "order_date date, customer_id string")
    numbers = visitors.customer_numbers(orders)
    held = sorted(r["number"] for r in numbers.collect())
    assert held == list(range(1, len({c for _, c in rows} - {None}) + 1)) and held[-1] > 32_768  # more than one bucket
    bitmaps = visitors.day_bitmaps(orders, numbers)
    found = {(r["period"], r["period_start"]): r["unique_customers"] for r in visitors.customers_by_period(bitmaps).collect()}
    expected = {}
    for d, c in rows:
        if c is not None:
            quarter = d.replace(month=(d.month - 1) // 3 * 3 + 1, day=1)
            for key in (("day", d), ("month", d.replace(day=1)), ("quarter", quarter)):
                expected.setdefault(key, set()).add(c)
    assert found == {k: len(v) for k, v in expected.items()}


def test_known_customers_keep_their_numbers(spark):
    first = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "customer_id string")
    numbers = visitors.customer_numbers(first)
    later = visitors.customer_numbers(first.unionByName(spark.createDataFrame([("0",), ("z",)], "customer_id string")), numbers)
    assert {r[0]: r[1] for r in later.collect()} == {"a": 1, "b": 2, "0": 3, "z": 4}


# ---------------------------------------------------------------- runs


def feeds(spark, delivery):
    x = Lake(spark, SMALL)
    return {
        "products": star.bronze_products(spark, SMALL, (delivery,)), "customers": x.customers, "orders": x.order_feed,
        "inventory": x.inventory, "campaigns": x.campaigns,
    }


ARRIVAL = {"customers": ["signup_date"], "campaigns": ["ingestion_timestamp"]}


@pytest.fixture(scope="module")
def two_runs(spark, tmp_path_factory):
    tables = Tables(spark, str(tmp_path_factory.mktemp("runs")))
    arrival = ARRIVAL | {"orders": star.order_arrival()}
    counts = [refresh(tables, feeds(spark, n), day, f"r{n}", arrival) for n, day in ((1, star.FIRST_DAY), (2, star.AS_OF))]
    return tables, counts


def loads_scanned(df):
    return {f.split("load_id=")[1].split("/")[0] for f in df.inputFiles() if "load_id=" in f}


def test_winners_are_those_of_all_loads(spark, two_runs):
    tables, _ = two_runs
    everything = tables.read_appended("bronze_products")
    state = tables.read("product_winners").filter("price > 0").select("product_id", "ingestion_timestamp", "price")
    latest = silver.latest_products(everything).select("product_id", "ingestion_timestamp", "price")
    assert sorted(state.collect()) == sorted(latest.collect()) and state.count() > 0
    ids = everything.select("product_id").distinct()
    assert tables.read("product_winners").count() == ids.count()
    columns = ["product_id", "inventory_date", "inventory_id", "stock_quantity"]
    newest = silver.latest_inventory(tables.read_appended("bronze_inventory")).select(*columns)
    assert sorted(tables.read("inventory_winners").select(*columns).collect()) == sorted(newest.collect())


def test_a_run_reads_its_own_loads(spark, two_runs):
    tables, _ = two_runs
    for bronze, clean, state in (
        ("bronze_products", "silver_products", "product_winners"), ("bronze_inventory", "silver_inventory", "inventory_winners"),
    ):
        seen = with_winners(tables, bronze, clean, state, "r2")
        text = seen._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in text and "(load_id" in text and "r2" in text and "r1)" not in text
        assert refresh_module._unread_loads(tables, bronze, clean, "r2") == ["r2"]
        assert refresh_module._unread_loads(tables, bronze, clean, "r3") == []


def test_key_index_follows_the_loads(spark, two_runs, tmp_path):
    tables, counts = two_runs
    index = KeyedTable(spark, f"{tables.root}/index/bronze_orders", ["order_id"])
    assert index.covers(2) and counts[1]["bronze_orders"] == 0
    stored = tables.read_appended("bronze_orders").select("order_id")
    assert sorted(index.read().select("order_id").collect()) == sorted(stored.collect())
    # An index that has lost its loads is built anew, and nothing is loaded twice.
    alone = Tables(spark, str(tmp_path))
    feed = feeds(spark, 1)["orders"]
    one = lambda run: refresh_module._insert_ignore(alone, "bronze_orders", ["order_id"], feed, star.order_arrival(), run)
    assert one("a") == counts[0]["bronze_orders"] == one("a")
    import shutil

    shutil.rmtree(tmp_path / "index")
    assert one("b") == 0
    assert KeyedTable(spark, f"{alone.root}/index/bronze_orders", ["order_id"]).covers(2)


def test_bisect_agrees_with_plain():
    """The plain search of these tests, against another one."""
    periods = [(1, a, a + 2) for a in range(0, 30, 3)]
    starts = [a for _, a, _ in periods]
    for t in range(30):
        assert plain(periods, 1, t) == f"1@{starts[bisect.bisect_right(starts, t) - 1]}"
