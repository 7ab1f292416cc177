"""What stays on disk: shuffled files, stored steps, and rows that need not move."""

import datetime as dt
import os
import time

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from martlet import schemas
from martlet.operators.joins import interval_join
from martlet.plans import cells
from martlet.queries import Lake, _stored
from martlet.queries import lake as shared_lake
from martlet.session import dropped, scratch_root, stored
from martlet.sources import keyed
from martlet.sources.keyed import KeyedTable
from martlet.sources.tables import Tables


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SMALL)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def held(spark):
    return set(os.listdir(scratch_root(spark).removeprefix("file:")))


def shuffled_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(files.size()) if (f := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffled_files_go_when_an_execution_ends(spark, lake):
    before = shuffled_files(spark)
    moved = spark.range(20_000).withColumn("k", F.col("id") % 7).repartition(5, "k")
    moved.write.format("noop").mode("overwrite").save()
    for _ in range(50):
        if not shuffled_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffled_files(spark) - before


def test_a_plan_runs_again_after_its_files_are_gone(spark, lake):
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().orderBy("k")
    first = sums.collect()
    time.sleep(1)
    assert sums.collect() == first and len(first) == 7


def test_dropped_deletes_stored_steps_only(spark, tmp_path):
    step = stored(spark.range(10), "one-step")
    other = str(tmp_path / "table" / "load")
    spark.range(10).write.parquet(other)
    dropped(spark, spark.read.parquet(other).inputFiles() + step.inputFiles())
    assert not any(f.startswith("one-step") for f in held(spark))
    assert spark.read.parquet(other).count() == 10


def test_two_runs_leave_no_steps_behind(spark):
    before = held(spark)
    tables, counts = shared_lake(spark, SMALL).two_runs
    left = {f for f in held(spark) - before if f.startswith(("stored-", "batch-keys-"))}
    assert not left and counts["day-2"]["bronze_orders"] == 0 < tables.read("silver_orders").count()


def resent(spark, path, batch):
    table = KeyedTable(spark, path, ["a", "b"], buckets=4)
    table.insert_ignore(0, spark.createDataFrame([(1, "x", "0"), (None, "x", "0"), (2, None, "0")], "a int, b string, note string"))
    return table, table.new_rows(1, batch, [F.col("note")])


@pytest.mark.parametrize("few", [0, 1, 100])
def test_a_batch_of_known_keys_stays_where_it_is(spark, tmp_path, monkeypatch, few):
    """Only the keys move to tell what is new; the same rows come out however many are new, null keys included."""
    monkeypatch.setattr(keyed, "FEW_KEYS", few)
    rows = [(1, "x", "1"), (None, "x", "1"), (2, None, "1"), (3, "x", "2"), (3, "x", "1"), (None, None, "1"), (None, None, "0")]
    table, new = resent(spark, str(tmp_path), spark.createDataFrame(rows, "a int, b string, note string"))
    assert ("LeftSemi" in plan_of(new)) == (few >= 4)
    assert sorted(map(tuple, new.select("a", "b", "note").collect()), key=repr) == [(3, "x", "1"), (None, None, "0")]
    table.store(1, new.drop(keyed.BUCKET))
    assert table.read().count() == 5
    assert not any(f.startswith("batch-keys-") for f in held(spark))


def test_a_batch_sent_again_is_not_exchanged(spark, tmp_path):
    again = spark.createDataFrame([(1, "x", "1"), (2, None, "1")], "a int, b string, note string")
    text = plan_of(resent(spark, str(tmp_path), again)[1])
    assert "BroadcastHashJoin" in text[: text.index("LeftSemi")]
    assert text.index("LeftSemi") < text.index("LeftAnti")
    assert all("note" not in line for line in text[text.index("LeftAnti") :].splitlines() if "Exchange" in line)


def test_product_days_take_one_exchange(lake, monkeypatch):
    tables, plans = _stored(lake, "product-days"), {}
    write = Tables._write

    def seen(self, table, df, target, by, placed=False):
        plans[table] = plan_of(df if placed else df.hint("rebalance", *by))
        return write(self, table, df, target, by, placed)

    monkeypatch.setattr(Tables, "_write", seen)
    cells.update_cells(tables, None)
    assert plans["product_days"].count("Exchange") == 1 and "rangepartitioning" in plans["product_days"]
    days = tables.read("product_days")
    assert days.count() == days.select("order_date", "product_id", "promo_code").distinct().count()
    assert days.agg(F.sum("n_orders")).first()[0] == lake.clean_orders.count()


def test_marts_find_first_orders_before_they_look_for_customers(lake, monkeypatch):
    """Clean orders are written from stored first records, which are gone afterwards; they are the same rows."""
    plans = {}
    overwrite = Tables.overwrite

    def seen(self, table, df, *more, **named):
        plans[table] = plan_of(df)
        return overwrite(self, table, df, *more, **named)

    monkeypatch.setattr(Tables, "overwrite", seen)
    tables = _stored(lake, "first-orders-test")
    assert "Window" not in plans["silver_orders"] and "lineitem" not in plans["silver_orders"]
    assert not any(f.startswith("first-orders-") and "test" not in f for f in held(lake.spark))
    names = schemas.column_names("silver_orders")
    kept, made = tables.read("silver_orders").select(*names), lake.clean_orders.select(*names)
    assert kept.exceptAll(made).isEmpty() and made.exceptAll(kept).isEmpty() and not kept.isEmpty()


def test_interval_join_leaves_out_days_of_no_interval(spark):
    day = dt.date(2001, 7, 1)
    schema = "id string, promo string, s date, e date"
    spans = [("a", "X", day, day + dt.timedelta(2)), ("b", "X", day + dt.timedelta(200), day + dt.timedelta(100)), ("c", "X", day, None)]
    used = spark.createDataFrame([("X", day + dt.timedelta(i - 3), i) for i in range(300)], "promo string, d date, n int")
    matched = interval_join(used, spark.createDataFrame(spans, schema), "promo", "d", "s", "e")
    assert sorted((r["id"], r["n"]) for r in matched.collect()) == [("a", 3), ("a", 4), ("a", 5)]
    text = matched._jdf.queryExecution().optimizedPlan().toString()
    first = (day - dt.date(1970, 1, 1)).days + (1 << 21)
    assert f">= {first})" in text and f"<= {first + 2})" in text
    none = interval_join(used, spark.createDataFrame(spans[1:], schema), "promo", "d", "s", "e")
    assert none.columns == matched.columns and none.count() == 0
