"""Small tables for the rules that are easy to get wrong."""

import datetime as dt
import random
from decimal import Decimal as D

from pyspark.sql import functions as F

from martlet import schemas
from martlet.functions import labels
from martlet.functions.numeric import exact_avg, pct
from martlet.functions.ordering import largest_first
from martlet.operators.amounts import order_amounts
from martlet.operators.history import scd2_apply, scd2_as_of, scd2_changes
from martlet.operators.joins import calendar_pieces, dyadic_blocks, interval_join, vs_previous_day
from martlet.operators.latest import latest_per_key
from martlet.operators.merge import insert_ignore, merge_subset
from martlet.operators.quality import gate, require_keys, ri_coverage, unique_on
from martlet.plans import gold, silver
from martlet.plans.refresh import PRODUCT_HISTORY, price_reason

DAY = dt.date(2001, 8, 1)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def one(spark, column):
    return spark.range(1).select(column).first()[0]


# ---------------------------------------------------------------- numbers and labels


def test_rounding_is_half_up_and_happens_once(spark):
    dec = lambda x: F.lit(D(x)).cast("decimal(20,2)")
    assert one(spark, exact_avg(dec("1.01"), F.lit(2).cast("long"))) == D("0.51")
    assert one(spark, exact_avg(dec("-1.01"), F.lit(2).cast("long"))) == D("-0.51")
    # 0.33333349 would reach 0.34 only through an intermediate rounding.
    assert one(spark, exact_avg(dec("0.67"), F.lit(2).cast("long"))) == D("0.34")
    assert one(spark, pct(F.lit(1).cast("long"), F.lit(0).cast("long"))) is None
    assert one(spark, pct(F.lit(1).cast("long"), F.lit(3).cast("long"))) == D("33.33")


def test_labels_at_their_limits(spark):
    prices = spark.createDataFrame([(D("49.99"),), (D("50"),), (D("200"),), (D("200.01"),)], "p decimal(10,2)")
    assert [r[0] for r in prices.select(labels.price_tier(F.col("p"))).collect()] == [
        "Budget", "Mid-range", "Mid-range", "Premium",
    ]
    stock = spark.createDataFrame([(0, 10), (9, 10), (10, 10), (50, 10), (51, 10), (0, 0)], "s int, r int")
    assert [r[0] for r in stock.select(labels.stock_status(F.col("s"), F.col("r"))).collect()] == [
        "Out of Stock", "Low Stock", "In Stock", "In Stock", "Overstock", "Out of Stock",
    ]
    risk = spark.createDataFrame([(90,), (91,), (180,), (181,), (9999,)], "d int")
    assert [r[0] for r in risk.select(labels.churn_risk(F.col("d"))).collect()] == [
        "Low", "Medium", "Medium", "High", "High",
    ]
    people = spark.createDataFrame(
        [(29, 60000, True), (30, 50001, True), (366, 50000, True), (365, 0, True), (181, 60000, False),
         (181, 1, None), (180, 1, False)],
        "age int, spend int, active boolean",
    )
    segment = labels.lifecycle_segment(F.col("age"), F.col("spend"), F.col("active"))
    assert [r[0] for r in people.select(segment).collect()] == [
        "New", "VIP", "Loyal", "Regular", "Churned", "Churned", "Regular",
    ]


def test_missing_fields_cost_quality(spark):
    df = spark.createDataFrame(
        [("t", "d", "i", D(1)), ("", "d", "i", D(1)), (None, None, None, None), ("t", "d", "i", D(0))],
        "t string, d string, i string, r decimal(3,2)",
    )
    score = labels.quality_score(*[F.col(c) for c in "tdir"])
    assert [r[0] for r in df.select(score).collect()] == [100, 80, 40, 90]


def test_change_reasons(spark):
    df = spark.createDataFrame(
        [(D("1.50"), D("2.00"), "Budget", "Budget"), (D(1), D(60), "Budget", "Mid-range"), (D(1), D(1), "Budget", None)],
        "a decimal(10,2), b decimal(10,2), c string, d string",
    )
    reason = labels.price_change_reason(*[F.col(c) for c in "abcd"])
    assert [r[0] for r in df.select(reason).collect()] == [
        "Price change: ₹1.50 → ₹2.00",
        "Price change: ₹1.00 → ₹60.00; Tier change: Budget → Mid-range",
        "Tier change: Budget → None",
    ]


def test_email_and_name_text(spark):
    df = spark.createDataFrame(
        [("a@b.cd",), ("a@b.cd\n",), ("a@b.cd\r",), ("a@b.c",), ("@b.cd",), ("a b@c.de",), ("A.b+c%d@x-y.Example",), (None,)],
        "e string",
    )
    assert [r[0] for r in df.select(labels.valid_email(F.col("e"))).collect()] == [
        True, True, False, False, False, False, True, None,
    ]
    names = spark.createDataFrame([("A", "B"), (" \tA", "B\n"), (None, "B"), ("A", None), (None, None)], "f string, l string")
    assert [r[0] for r in names.select(labels.full_name(F.col("f"), F.col("l"))).collect()] == ["A B", "A B", "B", "A", ""]


def test_amount_too_large_is_rejected_not_fatal(spark):
    df = spark.createDataFrame([(D("99999999.99"), 2, "NEW50")], "price decimal(10,2), qty int, promo string")
    done = order_amounts(df, "price", "qty", "promo", labels.PROMO_PERCENT)
    assert rows(done, "total_amount", "discount_amount", "final_amount") == [(None, None, None)]


def test_amounts(spark):
    df = spark.createDataFrame([(D("0.33"), 1, "NEW50"), (D("10.05"), 3, "SAVE10"), (D("5"), 2, None), (D("5"), 1, "X")],
                               "price decimal(10,2), qty int, promo string")
    done = order_amounts(df, "price", "qty", "promo", labels.PROMO_PERCENT)
    assert rows(done, "total_amount", "discount_amount", "final_amount") == [
        (D("0.33"), D("0.17"), D("0.16")), (D("5.00"), D("0.00"), D("5.00")), (D("10.00"), D("0.00"), D("10.00")),
        (D("30.15"), D("3.02"), D("27.13")),
    ]


# ---------------------------------------------------------------- gates


def test_gate_splits_completely_and_null_is_rejected(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, None), (None, -1)], "id int, v int")
    good, bad = gate(df, {"positive": F.col("v") > 0, "has_id": F.col("id").isNotNull()})
    assert rows(good) == [(1, 5)]
    assert {r["id"]: sorted(r["reasons"]) for r in bad.collect()} == {
        2: ["positive"], 3: ["positive"], None: ["has_id", "positive"],
    }


def test_duplicate_values_keep_the_smallest_key(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y"), ("d", None), ("e", None)], "id string, email string")
    kept, rest = unique_on(df, ["email"], keep="id")
    assert rows(kept, "id") == [("a",), ("c",), ("d",), ("e",)]
    assert rows(rest, "id") == [("b",)]


def test_known_keys(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    dim = spark.createDataFrame([("a",), ("a",), ("z",)], "k string")
    known, unknown = require_keys(fact, dim, "k")
    assert rows(known, "id") == [(1,)]
    assert rows(unknown, "id") == [(2,), (3,)]
    assert ri_coverage(fact.filter("k is not null"), dim, "k").first() == (1, 1, 2)


def test_schema_rules_cover_lengths_and_required_columns(spark):
    df = spark.createDataFrame([("x" * 21,), (None,)], "phone string")
    rules = schemas.schema_rules("silver_customers", ["phone"])
    good, bad = gate(df, rules)
    assert rows(good) == [(None,)] and bad.first()["reasons"] == ["phone_too_long"]
    assert "customer_id_required" in schemas.schema_rules("silver_customers")


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([("c1", None)], "customer_id string, country string")
    row = schemas.with_defaults(df, "silver_customers").first()
    assert row["country"] is None and row["loyalty_tier"] == "Bronze" and row["is_active"] is True


# ---------------------------------------------------------------- latest rows and merges


def test_missing_time_counts_as_newest(spark):
    df = spark.createDataFrame([(1, DAY, "old"), (1, None, "unknown"), (2, DAY, "only")], "k int, d date, v string")
    assert rows(latest_per_key(df, ["k"], [largest_first("d")]), "k", "v") == [(1, "unknown"), (2, "only")]


def test_bad_newest_version_exposes_the_one_before(spark):
    df = spark.createDataFrame(
        [(1, D(5), dt.datetime(2001, 1, 1)), (1, D(0), dt.datetime(2001, 1, 2)), (2, D(-1), dt.datetime(2001, 1, 1))],
        "product_id int, price decimal(10,2), ingestion_timestamp timestamp_ntz",
    )
    assert rows(silver.latest_products(df), "product_id", "price") == [(1, D("5.00"))]


def test_first_writer_wins(spark):
    batch = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, "b")], "id string, at int, v string")
    target = spark.createDataFrame([("b", "kept")], "id string, v string")
    first = insert_ignore(None, batch, ["id"], [F.col("at")])
    assert rows(first, "id", "v") == [("a", "early"), ("b", "b")]
    assert rows(insert_ignore(target, batch, ["id"], [F.col("at")]), "id", "v") == [("a", "early")]


def test_partial_update_with_repeated_keys(spark):
    schema = "id string, name string, n int, t timestamp_ntz"
    target = spark.createDataFrame([("a", "A", 1, None), ("z", "Z", 9, None)], schema)
    batch = spark.createDataFrame(
        [("a", "ignored", 2, 1), ("a", "ignored", None, 2), ("b", "first", 5, 1), ("b", "second", 6, 2)],
        "id string, name string, n int, at int",
    )
    at = dt.datetime(2001, 8, 1)
    merged = merge_subset(target, batch, ["id"], ["n"], ["at"], touch_col="t", touched_at=at)
    by_id = {r["id"]: tuple(r)[1:] for r in merged.collect()}
    assert by_id == {"a": ("A", None, at), "z": ("Z", 9, None), "b": ("first", 6, None)}
    again = merge_subset(merged, batch, ["id"], ["n"], ["at"])
    assert {r["id"]: tuple(r)[1:3] for r in again.collect()} == {k: v[:2] for k, v in by_id.items()}


# ---------------------------------------------------------------- joins


def test_interval_join_is_closed_and_counts_overlaps(spark):
    campaigns = spark.createDataFrame(
        [("c1", "X", DAY, DAY + dt.timedelta(2)), ("c2", "X", DAY + dt.timedelta(2), DAY + dt.timedelta(3)),
         ("c3", "Y", DAY, DAY), ("c4", "X", DAY, DAY - dt.timedelta(1)), ("c5", "X", None, DAY)],
        "id string, promo string, s date, e date",
    )
    used = spark.createDataFrame([("X", DAY + dt.timedelta(i), i) for i in range(5)], "promo string, d date, n int")
    for step in ("day", "month", "dyadic"):
        args = (used, campaigns, "promo", "d", "s", "e")
        matched = interval_join(*args, step=step)
        assert rows(matched, "id", "n") == [("c1", 0), ("c1", 1), ("c1", 2), ("c2", 2), ("c2", 3)]
        everyone = interval_join(*args, how="left", step=step, key="id")
        assert sorted((r["id"], -1 if r["n"] is None else r["n"]) for r in everyone.collect()) == [
            ("c1", 0), ("c1", 1), ("c1", 2), ("c2", 2), ("c2", 3), ("c3", -1), ("c4", -1), ("c5", -1),
        ]


def test_open_ended_interval(spark):
    dim = spark.createDataFrame([("c", "X", DAY, dt.date(9999, 12, 31))], "id string, promo string, s date, e date")
    used = spark.createDataFrame([("X", DAY - dt.timedelta(1), 0), ("X", dt.date(2030, 2, 3), 1)], "promo string, d date, n int")
    for step in ("month", "dyadic"):
        assert rows(interval_join(used, dim, "promo", "d", "s", "e", step=step), "n") == [(1,)]
    blocks = dim.select(F.explode(dyadic_blocks(F.col("s"), F.col("e"))).alias("b")).select("b.*").collect()
    assert len(blocks) < 45


def test_dyadic_blocks_cover_each_day_once(spark):
    rng = random.Random(2)
    spans = [(dt.date(1969, 12, 20) + dt.timedelta(a), a, a + n) for a, n in ((rng.randrange(60), rng.randrange(-2, 70)) for _ in range(60))]
    start = dt.date(1969, 12, 20)
    rows_ = [(i, d, start + dt.timedelta(b)) for i, (d, _, b) in enumerate(spans)]
    found = spark.createDataFrame(rows_, "i int, s date, e date").withColumn("b", F.explode(dyadic_blocks(F.col("s"), F.col("e"))))
    epoch, covered = dt.date(1970, 1, 1), {i: [] for i in range(60)}
    for r in found.collect():
        first = (r["b"]["block"] << r["b"]["size"]) - (1 << 21)
        covered[r["i"]] += [epoch + dt.timedelta(first + k) for k in range(1 << r["b"]["size"])]
    for i, (_, a, b) in enumerate(spans):
        assert sorted(covered[i]) == [start + dt.timedelta(k) for k in range(a, b + 1)]


def test_calendar_pieces_cover_each_day_once(spark):
    rng = random.Random(3)
    start = dt.date(1969, 11, 25)
    spans = [(a, a + n) for a, n in ((rng.randrange(70), rng.choice([-1, 0, 5, 30, 91, 92, 93, 120, 400])) for _ in range(90))]
    rows_ = [(i, start + dt.timedelta(a), start + dt.timedelta(b)) for i, (a, b) in enumerate(spans)]
    found = spark.createDataFrame(rows_, "i int, s date, e date").withColumn("p", F.explode(calendar_pieces(F.col("s"), F.col("e"))))
    epoch, covered, months = dt.date(1970, 1, 1), {i: [] for i in range(90)}, 0
    for r in found.collect():
        day = epoch + dt.timedelta((r["p"] >> 1) - (1 << 21))
        after = day + dt.timedelta(1)
        if r["p"] % 2:
            months += 1
            assert day.day == 1
            after = (day + dt.timedelta(31)).replace(day=1)
        covered[r["i"]] += [day + dt.timedelta(k) for k in range((after - day).days)]
    assert months > 0
    for i, (a, b) in enumerate(spans):
        assert sorted(covered[i]) == [start + dt.timedelta(k) for k in range(a, b + 1)]


def test_interval_join_spreads_a_month_and_meets_only_matches(spark):
    """One code in one month is dealt over tasks by day, and no pair is made that a condition drops again."""
    start = dt.date(2001, 7, 1)
    dim = spark.createDataFrame([(f"c{i}", "X", start + dt.timedelta(i), start + dt.timedelta(i + 2)) for i in range(28)], "id string, promo string, s date, e date")
    used = spark.createDataFrame([("X", start + dt.timedelta(i % 31), i) for i in range(310)], "promo string, d date, n int")
    names = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"
    before = [spark.conf.get(n) for n in names]
    try:
        for name, value in zip(names, ("-1", "false")):
            spark.conf.set(name, value)
        matched = interval_join(used, dim, "promo", "d", "s", "e")
        assert matched.count() == 28 * 3 * 10
        assert matched.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        joins = [line for line in matched._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in line]
        assert len(joins) == 1 and ">=" not in joins[0] and "<=" not in joins[0]
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)


def test_gap_in_the_calendar_has_no_previous_day(spark):
    days = spark.createDataFrame(
        [(DAY, 5, "a"), (DAY + dt.timedelta(1), 7, None), (DAY + dt.timedelta(3), 9, "c")], "d date, v int, note string"
    )
    assert [tuple(r) for r in vs_previous_day(days, "d", "v").orderBy("d").collect()] == [
        (DAY, 5, "a", None), (DAY + dt.timedelta(1), 7, None, 5), (DAY + dt.timedelta(3), 9, "c", None),
    ]


# ---------------------------------------------------------------- history


def snapshot(spark, *records):
    return spark.createDataFrame(
        [(i, f"p{i}", "cat", D(p), t) for i, p, t in records],
        "product_id int, product_name string, category string, price decimal(10,2), price_tier string",
    )


def apply(spark, history, snap, day):
    return scd2_apply(history, snap, as_of=day, reason=price_reason, **PRODUCT_HISTORY)


def test_history_over_three_days(spark):
    empty = spark.createDataFrame([], schemas.struct_type("product_price_history"))
    first = apply(spark, empty, snapshot(spark, (1, "10", "Budget"), (2, "20", "Budget"), (3, "5", None)), DAY)
    later = DAY + dt.timedelta(10)
    snap = snapshot(spark, (1, "60", "Mid-range"), (3, "5", None), (4, "1", "Budget"))
    assert rows(scd2_changes(first, snap, "product_id", PRODUCT_HISTORY["tracked"])) == [
        ("new", 1), ("unchanged", 1), ("updated", 1),
    ]
    second = apply(spark, first, snap, later)
    end = dt.date(9999, 12, 31)
    assert rows(second, "product_id", "price", "valid_from", "valid_to", "is_current") == [
        (1, D("10.00"), DAY, later - dt.timedelta(1), False), (1, D("60.00"), later, end, True),
        (2, D("20.00"), DAY, end, True), (3, D("5.00"), DAY, end, True), (4, D("1.00"), later, end, True),
    ]
    # The same snapshot again changes nothing; a second change on one day leaves an empty period.
    assert rows(apply(spark, second, snap, later)) == rows(second)
    third = apply(spark, second, snapshot(spark, (1, "61", "Mid-range")), later)
    closed = third.filter((F.col("product_id") == 1) & (F.col("valid_from") == F.lit(later)) & ~F.col("is_current"))
    assert closed.first()["valid_to"] == later - dt.timedelta(1)
    current = third.filter("is_current").groupBy("product_id").count().filter("count > 1")
    assert current.count() == 0

    fact = spark.createDataFrame([(1, DAY), (1, later), (9, later)], "product_id int, at date")
    seen = scd2_as_of(second, fact, "product_id", "at")
    assert {(r["product_id"], r["at"]): r["price"] for r in seen.collect()} == {
        (1, DAY): D("10.00"), (1, later): D("60.00"), (9, later): None,
    }


# ---------------------------------------------------------------- marts


ORDER = (
    "order_id string, customer_id string, product_id int, quantity int, unit_price decimal(10,2), "
    "discount_amount decimal(10,2), final_amount decimal(10,2), order_date date, status string, promo_code string"
)


def order(i, day, status="completed", promo=None, amount="10", product=1, customer="c1"):
    return (f"o{i}", customer, product, 1, D(amount), D(0), D(amount), day, status, promo)


def test_unmatched_campaign_has_no_return_but_ranks_first(spark):
    campaigns = spark.createDataFrame(
        [("used", "u", "Email", "X", DAY, DAY, D(1), D(4)), ("idle", "i", "Email", "Y", DAY, DAY, D(1), D(4)),
         ("free", "f", "Email", "Y", DAY, DAY, D(1), D(0))],
        "campaign_id string, campaign_name string, channel string, promo_code string, start_date date, end_date date, "
        "budget decimal(12,2), actual_spend decimal(12,2)",
    )
    orders = spark.createDataFrame([order(1, DAY, promo="X"), order(2, DAY, "pending", "X")], ORDER)
    roi = {r["campaign_id"]: r for r in gold.campaign_roi(campaigns, orders, DAY).collect()}
    assert (roi["used"]["roi"], roi["used"]["roas"], roi["used"]["total_orders"]) == (D("150.00"), D("2.50"), 1)
    assert (roi["idle"]["roi"], roi["idle"]["campaign_rank"], roi["idle"]["performance_rating"]) == (None, 1, "Poor")
    assert (roi["free"]["roi"], roi["free"]["campaign_rank"]) == (D("0.00"), 3)


def test_unknown_cost_keeps_zero_profit_and_no_margin(spark):
    products = spark.createDataFrame(
        [(1, "a", "x", D(10), None), (2, "b", "x", D(10), None), (3, "c", "x", D(10), None)],
        "product_id int, product_name string, category string, price decimal(10,2), average_rating decimal(3,2)",
    )
    inventory = spark.createDataFrame([(1, None), (2, D(4))], "product_id int, cost_price decimal(10,2)")
    edge = DAY - dt.timedelta(30)
    orders = spark.createDataFrame(
        [order(1, edge), order(2, edge, product=2), order(3, edge - dt.timedelta(1), product=3)], ORDER
    )
    got = {r["product_id"]: r for r in gold.product_performance(products, orders, inventory, DAY).collect()}
    assert (got[1]["total_profit"], got[1]["profit_margin"]) == (D(0), None)
    assert (got[2]["total_profit"], got[2]["profit_margin"]) == (D(6), D(60))
    assert (got[3]["units_sold"], got[3]["profit_margin"], got[3]["overall_rank"]) == (0, D(0), 3)
