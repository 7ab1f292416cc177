"""The distributed ranks must equal the plain windows, ties, NULLs and hot values included."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.functions.ordering import SortKey
from martlet.operators import ranking
from martlet.operators.ranking import global_ntile, global_rank, rank_within
from martlet.session import pin


def table(spark, seed, n=700, spread=40):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all rows share one value, some have none, one group holds half of them.
        value = Decimal(7) if rng.random() < 0.34 else None if rng.random() < 0.1 else Decimal(rng.randrange(spread))
        rows.append((f"k{i:05d}", rng.choice(["a", "a", "b", "c", None]), value))
    return spark.createDataFrame(rows, "id string, grp string, v decimal(15,2)").repartition(5)


def plain_ntile(df, k, order):
    window = Window.orderBy(order.column(), F.col("id").asc_nulls_last())
    return df.withColumn("tile", F.ntile(k).over(window).cast("int"))


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("k", [1, 4, 5])
def test_ntile(spark, descending, k):
    order = SortKey("v", descending)
    df = table(spark, k)
    far = global_ntile(df, k, order, "id", "tile")
    assert set(far.collect()) == set(plain_ntile(df, k, order).collect())
    assert far.count() == 700


def test_ntile_with_fewer_rows_than_tiles(spark):
    df = table(spark, 9, n=3)
    order = SortKey("v", True)
    far = global_ntile(df, 5, order, "id", "tile")
    assert set(far.collect()) == set(plain_ntile(df, 5, order).collect())


def test_ntile_of_nothing(spark):
    df = table(spark, 1, n=2).filter("id = 'none'")
    assert global_ntile(df, 5, SortKey("v"), "id", "tile").collect() == []


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("spread", [2, 40, 10_000])
def test_rank(spark, descending, spread):
    df = table(spark, spread, spread=spread)
    order = SortKey("v", descending)
    far = global_rank(df, order, "id", "r")
    near = df.withColumn("r", F.rank().over(Window.orderBy(order.column())))
    assert set(far.collect()) == set(near.collect())


@pytest.mark.parametrize("spread", [2, 40])
def test_rank_within_groups(spark, spread):
    df = table(spark, spread + 1, spread=spread)
    order = SortKey("v", True)
    far = rank_within(df, ["grp"], order, "id", "r")
    near = df.withColumn("r", F.rank().over(Window.partitionBy("grp").orderBy(order.column())))
    assert set(far.collect()) == set(near.collect())


def test_rank_of_nothing(spark):
    df = table(spark, 1, n=2).filter("id = 'none'")
    assert rank_within(df, ["grp"], SortKey("v"), "id", "r").collect() == []


def test_what_is_pinned_is_one_range_exchange(spark, monkeypatch):
    """The rows are computed once and pinned; the order is made by a range exchange of the sort columns. Nothing is gathered."""
    plans = []

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return pin(df)

    monkeypatch.setattr(ranking, "pin", spy)
    df = table(spark, 3).withColumn("wide", F.concat("id", F.lit("x")))
    two = [ranking.Rank(["grp"], SortKey("v", True), "r"), ranking.Rank([], SortKey("v"), "s")]
    for run, orders in ((lambda: ranking.with_ranks(df, two, "id"), 2), (lambda: global_ntile(df, 5, SortKey("v"), "id", "t"), 1)):
        plans.clear()
        ranked = run()
        assert len(plans) == 1 + orders and "wide" in plans[0] and "Exchange range" not in plans[0]
        for text in plans[1:]:
            assert text.count("rangepartitioning") == 1 and "Window" not in text and "SinglePartition" not in text
            # The pinned rows are read as they are; what is exchanged is their sort columns.
            above = "\n".join(line for line in text.splitlines() if "Scan ExistingRDD" not in line)
            assert "hashpartitioning" not in text and "wide" not in above and "concat" not in text
        rest = ranked._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in rest and "SinglePartition" not in rest and "concat(id" not in rest


def test_two_ranks_at_once(spark):
    df = table(spark, 5)
    order = SortKey("v", True)
    found = ranking.with_ranks(df, [ranking.Rank([], order, "all"), ranking.Rank(["grp"], order, "own")], "id")
    plain = df.withColumn("all", F.rank().over(Window.orderBy(order.column()))).withColumn(
        "own", F.rank().over(Window.partitionBy("grp").orderBy(order.column()))
    )
    assert set(found.collect()) == set(plain.collect())
