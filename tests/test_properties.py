"""Random tables against row-by-row brute force, and invariants that must always hold."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from martlet import schemas
from martlet.operators.history import scd2_apply
from martlet.operators.joins import interval_join
from martlet.operators.merge import insert_ignore, merge_subset
from martlet.operators.quality import gate, unique_on
from martlet.plans.refresh import PRODUCT_HISTORY, price_reason

DAY = dt.date(2001, 8, 1)


@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_applying_rows_one_by_one(spark, seed):
    rng = random.Random(seed)
    # Half of the batch has one key.
    keys = [f"k{rng.randrange(12)}" if rng.random() < 0.5 else "hot" for _ in range(120)]
    batch = [(k, rng.choice(["x", "y", None]), rng.choice([1, 2, None]), i) for i, k in enumerate(keys)]
    stored = {f"k{i}": (f"old{i}", i) for i in range(6)}
    expected = dict(stored)
    for k, name, n, _ in batch:
        expected[k] = (expected[k][0], n) if k in expected else (name, n)

    target = spark.createDataFrame([(k, *v) for k, v in stored.items()], "id string, name string, n int")
    df = spark.createDataFrame(batch, "id string, name string, n int, at int").repartition(4)
    merged = merge_subset(target, df, ["id"], ["n"], ["at"])
    assert {r["id"]: (r["name"], r["n"]) for r in merged.collect()} == expected
    again = merge_subset(merged, df, ["id"], ["n"], ["at"])
    assert sorted(again.collect(), key=str) == sorted(merged.collect(), key=str)

    ignored = insert_ignore(target, df, ["id"], [F.col("at")])
    first = {}
    for k, name, n, _ in batch:
        first.setdefault(k, (name, n))
    assert {r["id"]: (r["name"], r["n"]) for r in ignored.collect()} == {
        k: v for k, v in first.items() if k not in stored
    }


@pytest.mark.parametrize("seed", range(2))
def test_history_invariants(spark, seed):
    rng = random.Random(seed)
    history = spark.createDataFrame([], schemas.struct_type("product_price_history"))
    seen = {}
    for step in range(4):
        as_of = DAY + dt.timedelta(days=3 * step)
        snapshot = {i: (D(rng.randrange(1, 4)), rng.choice(["a", None])) for i in range(15) if rng.random() < 0.8}
        for i, state in snapshot.items():
            versions = seen.setdefault(i, [])
            if not versions or versions[-1][1] != state:
                versions.append((as_of, state))
        snap = spark.createDataFrame(
            [(i, f"p{i}", "c", p, t) for i, (p, t) in snapshot.items()],
            "product_id int, product_name string, category string, price decimal(10,2), price_tier string",
        )
        history = scd2_apply(history, snap, as_of=as_of, reason=price_reason, **PRODUCT_HISTORY)
        history = spark.createDataFrame(history.collect(), history.schema)
    rows = {}
    for r in sorted(history.collect(), key=lambda r: r["valid_from"]):
        rows.setdefault(r["product_id"], []).append(r)
    assert {i: [(r["valid_from"], (r["price"], r["price_tier"])) for r in v] for i, v in rows.items()} == seen
    for versions in rows.values():
        assert [r["is_current"] for r in versions] == [False] * (len(versions) - 1) + [True]
        for earlier, later in zip(versions, versions[1:]):
            assert earlier["valid_to"] + dt.timedelta(days=1) == later["valid_from"]
        assert versions[-1]["valid_to"] == dt.date(9999, 12, 31)


@pytest.mark.parametrize("step", ["day", "month", "dyadic"])
def test_interval_join_equals_nested_loops(spark, step):
    rng = random.Random(7)
    day = lambda: DAY + dt.timedelta(days=rng.randrange(-70, 70))
    dims = [(f"c{i}", rng.choice("XXY"), day(), day()) for i in range(25)]
    facts = [(i, rng.choice("XXXYZ"), day()) for i in range(200)]
    expected = sorted((c, i) for c, code, s, e in dims for i, k, d in facts if k == code and s <= d <= e)
    got = interval_join(
        spark.createDataFrame(facts, "n int, code string, d date"),
        spark.createDataFrame(dims, "id string, code string, s date, e date"),
        "code", "d", "s", "e", step=step,
    )
    assert sorted((r["id"], r["n"]) for r in got.collect()) == expected


def test_gate_and_uniqueness_lose_no_row(spark):
    rng = random.Random(3)
    rows = [(f"id{i:03d}", rng.choice(["same", "same", f"m{i}", None]), rng.choice([1, 0, None])) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, mail string, n int")
    good, bad = gate(df, {"positive": F.col("n") > 0, "has_mail": F.col("mail").isNotNull()})
    assert good.count() + bad.count() == 300
    kept, rest = unique_on(df, ["mail"], keep="id")
    assert kept.count() + rest.count() == 300
    assert kept.filter("mail is not null").groupBy("mail").count().filter("count > 1").count() == 0
    assert kept.filter("mail = 'same'").first()["id"] == min(r[0] for r in rows if r[1] == "same")
