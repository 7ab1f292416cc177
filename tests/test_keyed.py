"""Tables in hash buckets of a key: what a load reads, how folders are merged, and repeated loads."""

import datetime as dt
import random
import shutil

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from martlet import schemas
from martlet.operators.merge import merge_subset
from martlet.plans import gold
from martlet.queries import Lake
from martlet.sources import star
from martlet.sources.keyed import BUCKET, KeyedTable, MergedTable
from martlet.streaming import ingest, revenue


def rows_of(df):
    return sorted(map(tuple, df.drop(BUCKET).collect()), key=repr)


def keys(spark, first, end, note="a"):
    return spark.range(first, end).select(F.col("id").alias("k"), F.lit(note).alias("note"))


def files_read(df):
    """Files that the scan of ``df`` opens, by its metrics."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        leaves = execution.executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_first_writer_wins_over_many_loads(spark, tmp_path):
    table, expected = KeyedTable(spark, str(tmp_path), ["k"], buckets=4, fan=3), {}
    for n in range(14):
        batch = keys(spark, 5 * n, 5 * n + 12, f"load {n}")
        table.insert_ignore(n, batch.unionByName(batch.limit(0)), [F.col("note")])
        expected = {k: f"load {n}" for k in range(5 * n, 5 * n + 12)} | expected
        sizes = [f.last - f.first + 1 for f in table.folders()]
        assert sum(sizes) == n + 1 and max(map(sizes.count, sizes)) <= 3
    assert rows_of(table.read()) == sorted(expected.items(), key=repr)
    assert [f.last - f.first + 1 for f in table.folders()] == [9, 3, 1, 1]
    assert len(list(tmp_path.glob("loads=*"))) <= 8  # merged folders are gone


def test_a_load_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=16)
    for n in range(3):
        table.insert_ignore(n, keys(spark, 1000 * n, 1000 * n + 1000))
    late = keys(spark, 77, 78).withColumn(BUCKET, table.bucket())
    bucket = late.first()[BUCKET]
    near = table.keys_near(late)
    assert files_read(table.read()) == 48 and files_read(near) == 3
    assert {r[0] for r in near.select(BUCKET).distinct().collect()} == {bucket}


def test_lookup(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=8)
    assert table.lookup(k=1) is None
    table.store(1, keys(spark, 0, 5000).filter("k % 2 = 0"))
    found = table.lookup(k=1234)
    assert rows_of(found) == [(1234, "a")] and files_read(found) == 1
    assert table.lookup(k=1235).count() == 0  # within the minima and maxima of its file
    with pytest.raises(ValueError):
        table.lookup(note="a")


def test_bloom_filters_are_written(spark, tmp_path):
    import pyarrow.parquet as pq

    KeyedTable(spark, str(tmp_path), ["k"], buckets=1).store(1, keys(spark, 0, 1000))
    file = next(tmp_path.glob("loads=*/*/part-*.parquet"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).statistics.min == 0
    text = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
        spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            spark._jvm.org.apache.hadoop.fs.Path(str(file)), spark._jsc.hadoopConfiguration()
        )
    )
    try:
        assert text.getFooter().getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0
    finally:
        text.close()


def test_repeated_and_dead_loads(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=4, fan=2)
    for n in range(5):
        for _ in range(2):  # each load is repeated before the next
            table.insert_ignore(n, keys(spark, 3 * n, 3 * n + 6, f"{n}"))
    whole = rows_of(table.read())
    assert [r[0] for r in whole] == sorted(range(18), key=lambda k: repr((k,))) and len(whole) == 18
    # A load, and a merge, that died before their markers.
    shutil.copytree(tmp_path / "loads=0000000004-0000000004", tmp_path / "loads=0000000005-0000000005")
    (tmp_path / "loads=0000000005-0000000005" / "_SUCCESS").unlink()
    assert rows_of(table.read()) == whole
    with pytest.raises(ValueError):
        table.store(1, keys(spark, 0, 1))


def test_empty_loads_and_null_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), ["k"], buckets=4, fan=2)
    for n in range(3):
        table.insert_ignore(n, keys(spark, 0, 0))
    assert table.read() is None
    null = spark.createDataFrame([(None, "first"), (3, "x")], "k long, note string")
    table.insert_ignore(3, null)
    table.insert_ignore(4, spark.createDataFrame([(None, "later"), (3, "y"), (4, "z")], "k long, note string"))
    table.insert_ignore(5, spark.createDataFrame([(None, "again")], "k long, note string"))
    assert rows_of(table.read()) == sorted([(None, "first"), (3, "x"), (4, "z")], key=repr)


def test_fifty_batches_of_orders(spark, tmp_path):
    """One file a batch, in any order: the table is that of one load, and the number of folders and files stays small."""
    x = Lake(spark, SMALL)
    records = x.order_feed.select("order_id", "customer_id", "final_amount", *star.ORDER_ARRIVAL)
    records.repartition(50).write.parquet(str(tmp_path / "inbox"))
    stream = ingest.stream_feed(spark, str(tmp_path / "inbox"), records.schema, max_files=1)
    table = KeyedTable(spark, str(tmp_path / "orders"), ["order_id"], buckets=8)
    ingest.ingest_stream(stream, table, str(tmp_path / "checkpoint"), star.order_arrival()).awaitTermination()
    found = table.read()
    assert found.count() == found.select("order_id").distinct().count() == 4599
    assert len(table.folders()) <= 14 and files_read(found) <= 14 * 8
    assert len(list((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))) == 50


# ---------------------------------------------------------------- daily revenue


def order(n, day, customer="c1", status="completed", amount="10.00"):
    return (f"o{n}", customer, 1, 2, day, status, amount, "1.00", None)


def stream_of(spark, inbox):
    return ingest.stream_feed(spark, str(inbox), schemas.struct_type("silver_orders"), max_files=1)


def deliver(spark, inbox, rows):
    names = "order_id, customer_id, product_id, quantity, order_date, status, final_amount, discount_amount, promo_code".split(", ")
    given = spark.createDataFrame(
        rows, "order_id string, customer_id string, product_id int, quantity int, order_date date, status string, final_amount string, discount_amount string, promo_code string"
    )
    schema = schemas.struct_type("silver_orders")
    shaped = given.select(*[(F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    shaped.coalesce(1).write.mode("append").parquet(str(inbox))
    return shaped


def test_late_orders_change_their_day_only(spark, tmp_path):
    inbox, root = tmp_path / "inbox", str(tmp_path / "state")
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    deliver(spark, inbox, [order(i, d, f"c{i % 3}") for i, d in enumerate(days)])
    before = {r["revenue_date"]: r for r in revenue.run_daily_revenue(spark, stream_of(spark, inbox), root).collect()}
    # Late: a customer of that day again, a new one, one without an id, and an order without a day.
    late = [order(90, days[4], "c1"), order(91, days[4], "c9", "cancelled"), order(92, days[4], None), order(93, None, "c1")]
    deliver(spark, inbox, late)
    rows = revenue.run_daily_revenue(spark, stream_of(spark, inbox), root).collect()
    after = {r["revenue_date"]: r for r in rows}
    assert (after[days[4]]["total_orders"], after[days[4]]["unique_customers"], after[days[4]]["completed_orders"]) == (4, 2, 3)
    assert after[None]["total_orders"] == 1
    assert [d for d in days if after[d] != before[d]] == [days[4], days[5]]  # and the growth of the next day
    # The second batch has stored the parts of its two days, and has read only the buckets of them.
    assert revenue.days_table(spark, root).read_load(1).count() == 2
    visits = revenue.visits_table(spark, root)
    pairs = spark.createDataFrame([(days[4], "c9")], "order_date date, customer_id string").withColumn(BUCKET, visits.bucket())
    assert files_read(visits.keys_near(pairs, before=1)) == 1 < files_read(visits.read(before=1))


def test_many_batches_fold_to_the_same_days(spark, tmp_path):
    orders = Lake(spark, SMALL).clean_orders
    orders.repartition(12, F.xxhash64("order_id")).write.parquet(str(tmp_path / "inbox"))
    root = str(tmp_path / "state")
    found = revenue.run_daily_revenue(spark, stream_of(spark, tmp_path / "inbox"), root)
    assert len(revenue.days_table(spark, root).folders()) < 12
    expected = gold.daily_revenue(orders)
    assert sorted(map(str, found.select(*expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert not (tmp_path / "state" / "orders").exists()


# ---------------------------------------------------------------- upserts


CUSTOMERS = "k long, name string, tier string, spend int, changed timestamp_ntz"


def upserts(spark, seed, n, keys):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(keys)]), f"n{seed}.{i}", rng.choice([None, "a", "b"]), rng.randrange(9), i, "extra") for i in range(n)]
    return spark.createDataFrame(rows, "k long, name string, tier string, spend int, arrival int, more string").filter("k is not null")


def test_upserts_equal_merges_one_by_one(spark, tmp_path):
    """Columns that are kept and updated, the time of the last change, keys repeated in a batch, new keys, merged folders, replays."""
    base = spark.createDataFrame([(k, f"base{k}", "z", 0, None) for k in range(20)], CUSTOMERS)
    table = MergedTable(spark, str(tmp_path), ["k"], ["tier", "spend"], "changed", buckets=4, fan=3)
    table.start(base)
    expected = base
    for n in range(1, 9):
        batch, at = upserts(spark, n, 15, 30), dt.datetime(2001, 1, n)
        for _ in range(1 + (n == 8)):  # the newest load may be repeated
            table.upsert(n, batch, ["arrival"], at)
        plain = merge_subset(expected, batch, ["k"], ["tier", "spend"], ["arrival"], "changed", at)
        expected = spark.createDataFrame(plain.collect(), CUSTOMERS)
    assert rows_of(table.merged().select(*expected.columns)) == rows_of(expected)
    assert len(table.folders()) <= 5 and table.merged().count() == expected.count()


def test_an_upsert_writes_its_batch(spark, tmp_path):
    """Bytes written by a batch are in proportion to it, not to the table."""
    table = MergedTable(spark, str(tmp_path), ["k"], ["spend"], buckets=4)
    table.start(spark.range(200_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit(0).alias("spend")))
    batch = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("name"), F.lit(7).alias("spend"), F.lit(1).alias("arrival"))
    table.upsert(1, batch, ["arrival"])

    def size(folder):
        return sum(f.stat().st_size for f in folder.rglob("*.parquet"))

    sizes = [size(tmp_path / f"loads={n:010d}-{n:010d}") for n in (0, 1)]
    assert sizes[1] < sizes[0] / 20  # mostly Bloom filters
    found = table.merged()
    assert found.count() == 200_000 and found.filter("spend = 7").count() == 100 and found.filter("name = 'x'").count() == 0
