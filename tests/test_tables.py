"""Versioned tables, the layered run and the streaming jobs."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from martlet import schemas
from martlet.operators.history import scd2_apply
from martlet.plans import bronze, gold
from martlet.plans import refresh as refresh_module
from martlet.plans.refresh import PRODUCT_HISTORY, apply_snapshot, merge_orders, price_reason, refresh
from martlet.queries import Lake
from martlet.sources import feeds, star
from martlet.sources.keyed import KeyedTable
from martlet.sources.tables import Tables
from martlet.streaming import ingest, revenue


def products(spark, *ids):
    row = ", ".join(
        f"named_struct('product_id', {i}, 'product_name', 'p{i}', 'price', {i}.5, 'category', 'c')" for i in ids
    )
    return spark.sql(f"SELECT inline(array({row}))")


def ids(df):
    return sorted(r["product_id"] for r in df.select("product_id").collect())


def test_readers_see_only_complete_versions(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    assert ids(tables.read("silver_products")) == []
    assert tables.overwrite("silver_products", products(spark, 1, 2)) == 2
    before = tables.read("silver_products")
    # A refresh that reads the table it replaces.
    tables.overwrite("silver_products", before.filter("product_id = 2").unionByName(tables.read("silver_products")))
    assert ids(tables.read("silver_products")) == [1, 2, 2]
    assert ids(before) == [1, 2]
    broken = f"{tables.path('silver_products')}/version=00000003"
    products(spark, 9).write.parquet(broken)
    os.remove(f"{broken}/_SUCCESS")
    assert ids(tables.read("silver_products")) == [1, 2, 2]
    tables.overwrite("silver_products", products(spark, 5))
    assert ids(tables.read("silver_products")) == [5]


def test_repeated_load_replaces_itself(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.append("silver_products", products(spark, 1), "a")
    tables.append("silver_products", products(spark, 2, 3), "b")
    tables.append("silver_products", products(spark, 2), "b")
    assert ids(tables.read_appended("silver_products")) == [1, 2]
    assert ids(tables.read_appended("silver_products", without_load="b")) == [1]


def test_partition_folders_are_pruned(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    inventory = star.bronze_inventory(spark, SMALL)
    tables.append("bronze_inventory", inventory, "a", ("inventory_date",))
    one_day = tables.read_appended("bronze_inventory").filter(F.col("inventory_date") == F.lit(star.AS_OF))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(inventory_date" in plan
    assert one_day.count() == 200


def lake_feeds(spark, day):
    x = Lake(spark, SMALL)
    customers = x.customers if day == 1 else star.bronze_customers_later(spark, SMALL)
    return {
        "products": star.bronze_products(spark, SMALL, (day,)),
        "customers": customers,
        "orders": x.order_feed,
        "inventory": x.inventory,
        "campaigns": x.campaigns if day == 1 else star.campaign_batch(spark, SMALL),
    }


def arrival(**own):
    return {"orders": star.order_arrival(), "customers": ["signup_date"], "campaigns": ["ingestion_timestamp"]} | own


def content(tables, table):
    return sorted(map(str, tables.read(table).collect()))


def test_two_day_run(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    first = refresh(tables, lake_feeds(spark, 1), star.FIRST_DAY, "day-1", arrival())
    assert first["bronze_orders"] == 4599 and first["silver_products"] > 0
    merged = ("bronze_customers", "bronze_campaigns")
    stored = {t: content(tables, t) for t in schemas.TABLES if t.startswith(("silver", "gold")) or "history" in t or t in merged}
    assert all(stored[t] for t in stored)

    order = tables.read_appended("bronze_orders").first()
    assert (order["source"], order["pipeline_run_id"]) == ("orders_feed", "day-1")
    assert json.loads(order["raw_json"])["order_id"] == order["order_id"]

    again = refresh(tables, lake_feeds(spark, 1), star.FIRST_DAY, "day-1", arrival())
    assert again == first
    assert {t: content(tables, t) for t in stored} == stored

    second = refresh(tables, lake_feeds(spark, 2), star.AS_OF, "day-2", arrival())
    assert second["bronze_orders"] == 0  # every id was known
    x = Lake(spark, SMALL)
    prices = tables.read("product_price_history").select("product_id", "price", "valid_from", "valid_to", "is_current")
    expected = x.price_history.select("product_id", "price", "valid_from", "valid_to", "is_current")
    assert sorted(prices.collect()) == sorted(expected.collect())
    # A merge never recomputes the quality score of a known product.
    titles = tables.read("silver_products").filter("product_name <> '' AND data_quality_score < 100")
    assert titles.count() > 0
    for mart in ("gold_daily_revenue", "gold_campaign_roi", "gold_inventory_health"):
        assert tables.read(mart).schema.fieldNames() == [*schemas.column_names(mart), "calculated_at"]
        assert {str(r[0]) for r in tables.read(mart).select("calculated_at").collect()} == {f"{star.AS_OF} 00:00:00"}
    periods = tables.read("product_price_history").select("is_current", "valid_from", "created_at", "updated_at").collect()
    days = {(r["is_current"], str(r["created_at"])[:10], str(r["updated_at"])[:10]) for r in periods}
    first_day, last_day = str(star.FIRST_DAY), str(star.AS_OF)
    assert days == {(True, first_day, first_day), (False, first_day, last_day), (True, last_day, last_day)}


def test_only_touched_months_are_rewritten(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    x = Lake(spark, SMALL)
    assert merge_orders(tables, x.clean_orders) == 4400
    stored = tables.read("silver_orders")
    n_months = stored.select("order_month").distinct().count()
    victim = stored.filter("status = 'pending'").orderBy("order_id").first()
    refund = stored.drop("order_month").filter(F.col("order_id") == victim["order_id"]).withColumns(
        {"status": F.lit("refunded"), "final_amount": F.lit(0).cast("decimal(10,2)"),
         "order_date": F.date_add("order_date", 400)}
    )
    assert merge_orders(tables, refund) == 4400
    folders = list((tmp_path / "silver" / "silver_orders").glob("version=00000002/order_month=*"))
    assert [f.name for f in folders] == [f"order_month={victim['order_month']}"]
    after = tables.read("silver_orders")
    assert after.select("order_month").distinct().count() == n_months
    changed = after.exceptAll(stored).collect()
    assert [(r["order_id"], r["status"], r["final_amount"], r["order_date"]) for r in changed] == [
        (victim["order_id"], "refunded", victim["final_amount"], victim["order_date"])
    ]
    assert merge_orders(tables, refund) == 4400  # nothing to do, nothing written
    assert len(tables.versions("silver_orders")) == 2
    plan = gold.product_sales(after, star.AS_OF, 30)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_few_products_are_few_pages(spark, tmp_path):
    """Rows of a month lie in the order of products and customers: a scan of one product opens its month and reads its pages."""
    n, month = 400_000, dt.date(2001, 7, 1)
    rows = spark.range(n).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.concat(F.lit("c"), F.xxhash64("id") % 5000).alias("customer_id"),
        (F.abs(F.xxhash64("id", F.lit(1))) % 400).cast("int").alias("product_id"),
        F.when(F.col("id") % 2 == 0, F.lit(month)).otherwise(F.lit(dt.date(2001, 6, 1))).alias("order_month"),
    )
    tables = Tables(spark, str(tmp_path))
    tables.overwrite("silver_orders", rows)
    stored = tables.read("silver_orders").select("order_id", "product_id", "order_month")

    def scanned(df):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            execution = df._jdf.queryExecution()
            execution.toRdd().count()
            scan = execution.executedPlan().collectLeaves().apply(0).metrics()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        return scan.apply("numFiles").value(), scan.apply("numOutputRows").value()

    files, all_rows = scanned(stored)
    some_files, some_rows = scanned(stored.filter((F.col("product_id") == 17) & (F.col("order_month") == F.lit(month))))
    assert all_rows == n and some_files <= files // 2 and some_rows <= n // 8
    assert stored.filter((F.col("product_id") == 17) & (F.col("order_month") == F.lit(month))).count() == rows.filter(
        (F.col("product_id") == 17) & (F.col("order_month") == F.lit(month))
    ).count()


def test_closed_periods_are_written_once(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    spec = {"reason": price_reason, **PRODUCT_HISTORY}

    def run(as_of, *priced):
        rows = [(i, f"p{i}", "c", Decimal(p), "t") for i, p in priced]
        snap = spark.createDataFrame(
            rows, "product_id int, product_name string, category string, price decimal(10,2), price_tier string"
        )
        return apply_snapshot(tables, "product_price_history", snap, as_of, "price_history_id", **spec)

    assert run(dt.date(2001, 1, 10), (1, 1), (2, 1)) == 2
    assert run(dt.date(2001, 1, 20), (1, 2), (2, 1)) == 3
    assert run(dt.date(2001, 1, 25), (1, 3), (2, 1)) == 4
    assert run(dt.date(2001, 3, 5), (1, 4), (2, 2)) == 6
    folders = sorted(f.parent.name + "/" + f.name for f in (tmp_path / "history").glob("*/*/closed_month=*"))
    assert [f for f in folders if f.startswith("version=00000004")] == [
        "version=00000004/closed_month=2001-03-01", "version=00000004/closed_month=9999-12-01",
    ]
    periods = tables.read("product_price_history").orderBy("product_id", "valid_from").collect()
    assert [(r["product_id"], int(r["price"]), r["valid_from"].isoformat(), r["is_current"]) for r in periods] == [
        (1, 1, "2001-01-10", False), (1, 2, "2001-01-20", False), (1, 3, "2001-01-25", False),
        (1, 4, "2001-03-05", True), (2, 1, "2001-01-10", False), (2, 2, "2001-03-05", True),
    ]
    assert run(dt.date(2001, 3, 5), (1, 4), (2, 2)) == 6


def customer_rows(spark, *rows):
    """Customers from (id, e-mail, spend, arrival)."""
    schema = "customer_id string, email string, total_lifetime_spend decimal(12,2), arrival int"
    made = spark.createDataFrame([(i, e, Decimal(s), at) for i, e, s, at in rows], schema)
    return made.withColumns(
        {
            "first_name": F.lit("A"), "last_name": F.lit("B"), "signup_date": F.lit(dt.date(2000, 1, 1)),
            "loyalty_tier": F.lit("Bronze"), "is_active": F.lit(True),
        }
    )


def run_customers(tables, feeds, run_id, *rows):
    customers = customer_rows(tables.spark, *rows)
    return refresh(tables, feeds | {"customers": customers}, star.AS_OF, run_id, arrival(customers=["arrival"]))


def emails(tables):
    return {r["customer_id"]: r["email"] for r in tables.read("silver_customers").collect()}


def test_customers_of_a_run_are_folded_and_keep_their_emails(spark, tmp_path):
    tables, feeds = Tables(spark, str(tmp_path)), lake_feeds(spark, 1)
    first = run_customers(tables, feeds, "r1", ("CUST9", "nine@x.yz", 1, 0), ("CUST9", "ten@x.yz", 5, 1), ("CUST3", "three@x.yz", 1, 0))
    rows = {r["customer_id"]: r for r in tables.read("bronze_customers").collect()}
    assert tables.read("bronze_customers").count() == 2 == first["bronze_customers_inserted"]
    assert (rows["CUST9"]["email"], int(rows["CUST9"]["total_lifetime_spend"])) == ("nine@x.yz", 5)
    assert emails(tables) == {"CUST9": "nine@x.yz", "CUST3": "three@x.yz"}
    # A new customer with a smaller id claims a held address and is quarantined, whoever comes first in it.
    second = run_customers(tables, feeds, "r2", ("CUST1000", "THREE@x.yz", 1, 0), ("CUST3", "three@x.yz", 2, 0))
    assert emails(tables) == {"CUST9": "nine@x.yz", "CUST3": "three@x.yz"}
    assert (second["silver_customers_inserted"], second["silver_customers_rejected"]) == (0, 1)
    before = sorted(map(str, tables.read("bronze_customers").collect()))
    again = run_customers(tables, feeds, "r2", ("CUST1000", "THREE@x.yz", 1, 0), ("CUST3", "three@x.yz", 2, 0))
    assert again == second and sorted(map(str, tables.read("bronze_customers").collect())) == before
    with pytest.raises(ValueError, match="cannot be repeated"):
        run_customers(tables, feeds, "r1", ("CUST9", "nine@x.yz", 1, 0))


@pytest.mark.parametrize("absent", ["products", "customers"])
def test_orders_need_products_and_customers(spark, tmp_path, absent):
    feeds = lake_feeds(spark, 1)
    feeds[absent] = feeds[absent].limit(0)
    with pytest.raises(ValueError, match=f"without {absent}"):
        refresh(Tables(spark, str(tmp_path)), feeds, star.FIRST_DAY, "r1", arrival())


def test_only_unseen_and_waiting_orders_are_judged(spark, tmp_path):
    """An order waits for its customer; judged loads are not read again."""
    tables, feeds = Tables(spark, str(tmp_path)), lake_feeds(spark, 1)
    run_customers(tables, feeds, "r1", ("CUST9", "nine@x.yz", 1, 0))
    waiting = tables.read("pending_orders")
    of = {r["customer_id"] for r in tables.read("silver_orders").select("customer_id").distinct().collect()}
    assert of == {"CUST9"} and waiting.filter("customer_id = 'CUST3'").count() > 0
    n = waiting.count()
    second = run_customers(tables, feeds, "r2", ("CUST3", "three@x.yz", 1, 0))
    assert second["bronze_orders"] == 0 and second["silver_orders_inserted"] == n - second["pending_orders"] > 0
    assert second["silver_orders_rejected"] == second["pending_orders"]
    again = run_customers(tables, feeds, "r2", ("CUST3", "three@x.yz", 1, 0))
    assert again == second
    customers, products = tables.read("bronze_customers"), tables.read_appended("bronze_products")
    seen = []
    monkey = refresh_module.pin
    try:
        refresh_module.pin = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or df
        refresh_module.judged_orders(tables, customers, products, "r3")
    finally:
        refresh_module.pin = monkey
    assert "bronze_orders" not in seen[0] or "PartitionFilters: [load_id" in seen[0]


def test_a_repeated_load_that_dies_leaves_the_first(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.append("silver_products", products(spark, 1, 2), "a")
    with pytest.raises(Exception, match="broken"):
        tables.append("silver_products", products(spark, 3).withColumn("price", F.raise_error(F.lit("broken"))), "a")
    assert ids(tables.read_appended("silver_products")) == [1, 2]
    tables.append("silver_products", products(spark, 4), "a")
    assert ids(tables.read_appended("silver_products")) == [4]


def test_a_period_with_an_unknown_flag_stays(spark):
    row = spark.sql(
        "SELECT 1 AS product_id, 'p' AS product_name, 'c' AS category, 1.00BD AS price, 't' AS price_tier, DATE'2001-01-01' AS valid_from, "
        "DATE'2001-01-31' AS valid_to, CAST(NULL AS BOOLEAN) AS is_current, 'r' AS change_reason"
    )
    after = scd2_apply(row, row.limit(0), as_of=dt.date(2001, 3, 1), reason=price_reason, **PRODUCT_HISTORY)
    assert after.count() == 1


def test_stamping_a_raw_feed(spark):
    at = dt.datetime(2001, 8, 1, 6)
    product = bronze.stamped("products", star.product_feed(spark, SMALL, 1), "r1", at).filter("product_id = 4").first()
    payload = json.loads(product["raw_json"])
    assert payload["id"] == 4 and payload["title"] == product["title"] == ""
    assert (product["source"], product["ingestion_timestamp"], product["pipeline_run_id"]) == ("products_feed", at, "r1")
    raw = star.bronze_inventory(spark, SMALL).drop("inventory_id", "source", "ingestion_timestamp", "pipeline_run_id")
    stamped = bronze.stamped("inventory", raw, "r1", at)
    assert stamped.select("inventory_id").distinct().count() == stamped.count() == 600


def test_history_ids_are_stable(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    refresh(tables, lake_feeds(spark, 1), star.FIRST_DAY, "day-1", arrival())
    rows = tables.read("product_price_history").select("price_history_id").distinct().count()
    assert rows == tables.read("product_price_history").count()


# ---------------------------------------------------------------- feeds


def test_product_feed_as_json(spark, tmp_path):
    path = tmp_path / "products.json"
    path.write_text(
        '[{"id": 1, "title": "t", "price": 9.99, "category": "c", "rating": {"rate": 4.5, "count": 3}},'
        ' {"id": 2, "title": "u", "price": 1, "category": "c", "image": "i"}]'
    )
    flat = feeds.flatten_products(feeds.read_feed(spark, "products", str(path), "json", multiLine=True))
    got = {r["product_id"]: r for r in flat.collect()}
    assert str(got[1]["rating_rate"]) == "4.50" and got[1]["image_url"] is None
    assert got[2]["rating_count"] is None and str(got[2]["price"]) == "1.00"


def test_empty_feed_is_an_error(spark, tmp_path):
    path = tmp_path / "products.json"
    path.write_text("[]")
    with pytest.raises(ValueError, match="no records"):
        feeds.read_feed(spark, "products", str(path), "json", multiLine=True)


def test_one_record_per_line(spark, tmp_path):
    path = tmp_path / "users.json"
    path.write_text('{"id": 1, "email": "a@b.cd"}\n{"id": 2}\n')
    assert feeds.read_feed(spark, "users", str(path), "json").count() == 2


def test_csv_feed_and_lineage(spark, tmp_path):
    path = tmp_path / "inventory.csv"
    path.write_text(
        "product_id,stock_quantity,warehouse_location,reorder_point,reorder_quantity,cost_price,supplier_name,"
        "last_restock_date,inventory_date\n7,3,W,1,2,4.50,S,2001-07-01,2001-08-01\n"
    )
    df = feeds.read_feed(spark, "inventory", str(path), "csv", filename_col="source_filename")
    row = feeds.with_lineage(df, "inventory_csv", "run-1", dt.datetime(2001, 8, 1)).first()
    assert row["inventory_date"] == dt.date(2001, 8, 1) and row["source_filename"].endswith("inventory.csv")
    assert (row["source"], row["pipeline_run_id"]) == ("inventory_csv", "run-1")


def test_user_feed(spark, tmp_path):
    path = tmp_path / "users.json"
    path.write_text('[{"id": 1, "email": "a@b.cd", "name": {"firstname": "x"}, "address": {"city": "y"}}]')
    assert feeds.read_feed(spark, "users", str(path), "json", multiLine=True).select("name.firstname").first()[0] == "x"


def test_lines_that_are_no_records_are_rescued(spark, tmp_path):
    sound = '{"id": %d, "title": "t", "price": 1.50, "rating": {"rate": 4.5, "count": 2}}'
    cut, wrong = '{"id": 7, "title": "t", "pri', '{"id": 8, "title": "t", "price": "many"}'
    (tmp_path / "a.json").write_text("\n".join([sound % 1, cut, "", sound % 2, wrong, "null?"]))
    records, rescued = feeds.split_feed(spark, "products", str(tmp_path))
    assert sorted(r["id"] for r in records.collect()) == [1, 2]
    lines = {r["line"]: json.loads(r["parsed"]) for r in rescued.collect()}
    assert set(lines) == {cut, wrong, "null?"} and lines[wrong] == {"id": 8, "title": "t"}
    assert all(r["source_filename"].endswith("a.json") for r in rescued.collect())
    rejects = feeds.rescued_rejects(rescued, "products").collect()
    assert {(r["table_name"], r["record_key"]) for r in rejects} == {("bronze_products", line) for line in lines}
    assert rescued.count() == 3
    (tmp_path / "a.json").write_text(cut)
    with pytest.raises(ValueError, match="no records"):
        feeds.split_feed(spark, "products", str(tmp_path))


def test_unparsable_dates_become_null(spark):
    df = spark.createDataFrame([("2001-02-03", "2001-02-03T04:05:06"), ("x", "y")], "d string, t string")
    assert [tuple(r) for r in feeds.parse_iso(df, ["d"], ["t"]).collect()] == [
        (dt.date(2001, 2, 3), dt.datetime(2001, 2, 3, 4, 5, 6)), (None, None),
    ]


# ---------------------------------------------------------------- streams


def test_incremental_batches_equal_one_load(spark, tmp_path):
    x = Lake(spark, SMALL)
    records = x.order_feed.select("order_id", "customer_id", "final_amount", *star.ORDER_ARRIVAL)
    inbox, target, checkpoint = (str(tmp_path / n) for n in ("inbox", "orders", "checkpoint"))
    # Two deliveries, the second overlapping the first; file by file.
    records.filter("l_quantity < 30").repartition(2).write.parquet(inbox)
    def run():
        stream = ingest.stream_feed(spark, inbox, records.schema, max_files=1)
        ingest.ingest_stream(stream, KeyedTable(spark, target, ["order_id"]), checkpoint, star.order_arrival()).awaitTermination()

    run()
    n_first = spark.read.parquet(target).count()
    assert n_first == records.filter("l_quantity < 30").select("order_id").distinct().count()
    records.coalesce(1).write.mode("append").parquet(inbox)
    run()
    result = spark.read.parquet(target)
    assert result.count() == result.select("order_id").distinct().count() == 4599
    run()  # nothing new
    assert spark.read.parquet(target).count() == 4599


def test_stream_revenue_equals_batch_whatever_the_order_of_files(spark, tmp_path):
    """Six files without order in time, one per batch: no order is late and every day is current."""
    orders, root = Lake(spark, SMALL).clean_orders, str(tmp_path / "out")
    orders.repartition(6, F.xxhash64("order_id")).write.parquet(str(tmp_path / "inbox"))
    stream = ingest.stream_feed(spark, str(tmp_path / "inbox"), schemas.struct_type("silver_orders"), max_files=1)
    found = revenue.run_daily_revenue(spark, stream, root)
    assert len(list((tmp_path / "out" / "days").glob("loads=*"))) >= 3
    assert found.agg(F.sum("total_orders")).first()[0] == 4400
    expected = gold.daily_revenue(orders)
    assert sorted(map(str, found.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
