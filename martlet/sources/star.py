"""Commerce feeds derived from a star schema of parts, customers, orders and order lines.

Every feed covers its whole source table. Irregular records (missing fields,
rejected prices, unknown customers, repeated keys) come from deterministic
expressions on the row itself; FIXTURES.md lists them. All results of this module
are lazy, so a query scans only the columns it uses.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.dates import day
from martlet.functions.labels import LOYALTY_TIERS, PROMO_PERCENT
from martlet.functions.ordering import smallest_first
from martlet.operators.amounts import order_amounts
from martlet.sources.feeds import flatten_products, with_lineage

AS_OF = dt.date(2001, 8, 1)
FIRST_DAY = AS_OF - dt.timedelta(days=10)

#: Promotion codes of the campaigns with the percentage that is announced; ``None`` stands for a code of their own.
CAMPAIGN_CODES = (("SAVE10", 10), ("FLASH20", 20), ("NEW50", 50), ("WEEK15", 15), (None, 25))


# Layout of the source tables. Readers never infer.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], index: Column) -> Column:
    """``values[index]`` for an index known to be in range."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def list_price(retail: Column) -> Column:
    """Spread the narrow retail range over all price tiers, zero included."""
    return ((retail.cast("decimal(10,2)") - 900) * 5).cast("decimal(10,2)")


def midnight(value: dt.date) -> dt.datetime:
    return dt.datetime.combine(value, dt.time())


# ---------------------------------------------------------------- products


def product_feed(spark: SparkSession, sf_dir: str, delivery: int) -> DataFrame:
    """The product records of delivery 1 (ten days earlier) or 2 (the as-of day)."""
    part = table(spark, sf_dir, "part")
    pk, listed = F.col("p_partkey"), list_price(F.col("p_retailprice"))
    if delivery == 1:
        price = F.when(pk % 19 == 18, 0).otherwise(listed)
        untitled = pk % 17 == 4
    else:
        price = F.when(pk % 13 == 0, F.round(listed * F.lit(110) / 100, 2)).when(pk % 31 == 7, 0).otherwise(listed)
        untitled = pk % 34 == 4
    rate = F.when(pk % 11 == 5, 0).otherwise(F.col("p_size") % 41 * F.lit("0.1").cast("decimal(2,1)") + 1)
    return part.select(
        pk.cast("int").alias("id"),
        F.when(untitled, "").otherwise(F.col("p_name")).alias("title"),
        price.cast("decimal(10,2)").alias("price"),
        F.when(pk % 10 != 3, F.concat_ws(" ", "p_type", "p_name")).alias("description"),
        F.col("p_type").alias("category"),
        F.when(pk % 7 != 2, F.concat(F.lit("https://img.example.com/"), pk)).alias("image"),
        F.struct(
            rate.cast("decimal(3,2)").alias("rate"), (F.col("p_size") * 7).cast("int").alias("count")
        ).alias("rating"),
    )


def bronze_products(spark: SparkSession, sf_dir: str, deliveries: tuple[int, ...] = (1, 2)) -> DataFrame:
    """All versions of all products, newest delivery last."""
    arrived = {1: FIRST_DAY, 2: AS_OF}
    versions = [
        with_lineage(
            flatten_products(product_feed(spark, sf_dir, d)), "product_feed", f"load-{d}", midnight(arrived[d])
        )
        for d in deliveries
    ]
    return versions[0] if len(versions) == 1 else versions[0].unionByName(versions[1])


# ---------------------------------------------------------------- customers


def tier_index(balance: Column) -> Column:
    return F.when(balance < 2500, 0).when(balance < 5000, 1).when(balance < 8000, 2).otherwise(3)


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ck = F.col("c_custkey")
    place = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    address = F.concat(F.translate("c_name", "#", "."), F.lit("@"), F.col("c_mktsegment"), F.lit(".Example.com"))
    recent = F.date_sub(day(AS_OF), (ck % 29).cast("int"))
    earlier = F.date_add(day(dt.date(1998, 8, 1)), (ck * 37 % 1060).cast("int"))
    return (
        table(spark, sf_dir, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.concat(F.lit("CUST"), ck).alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            ck.cast("string").alias("last_name"),
            F.when(ck % 50 == 7, F.col("c_name")).when(ck % 50 != 9, address).alias("email"),
            F.concat(F.lit("+91-"), F.lpad(ck.cast("string"), 10, "0")).alias("phone"),
            F.concat(ck, F.lit(" Market Road")).alias("street_address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lpad((ck % 1000000).cast("string"), 6, "0").alias("postal_code"),
            F.lit("India").alias("country"),
            F.when(ck % 40 == 7, recent).otherwise(earlier).alias("signup_date"),
            pick(LOYALTY_TIERS, tier_index(F.col("c_acctbal"))).alias("loyalty_tier"),
            (F.col("c_acctbal").cast("decimal(12,2)") * 10).cast("decimal(12,2)").alias("total_lifetime_spend"),
            (ck % 20 != 0).alias("is_active"),
        )
    )


def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the nested user records of the service that signs them up."""
    place = table(spark, sf_dir, "nation")
    ck = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            ck.cast("int").alias("id"),
            F.when(ck % 50 != 9, F.concat(F.translate("c_name", "#", "."), F.lit("@example.com"))).alias("email"),
            F.concat(F.lit("user"), ck).alias("username"),
            F.struct(F.col("c_mktsegment").alias("firstname"), F.col("c_name").alias("lastname")).alias("name"),
            F.when(ck % 10 != 3, F.concat(F.lit("+"), ck * 7)).alias("phone"),
            F.struct(
                F.col("n_name").alias("city"), F.lit("Main Street").alias("street"), (ck % 200).cast("int").alias("number"),
                (ck % 90_000 + 10_000).cast("string").alias("zipcode"),
            ).alias("address"),
        )
    )


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of ``bronze_customers``, without the place lookup behind its other columns."""
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("CUST"), "c_custkey").alias("customer_id"))


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = with_lineage(customer_feed(spark, sf_dir), "customer_feed", "load-1", midnight(FIRST_DAY))
    return stamped.withColumn("last_modified_date", F.lit(None).cast("timestamp_ntz"))


def bronze_customers_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers on the as-of day: some tiers one step up, some spend or activity changed."""
    ck = F.col("last_name").cast("long")
    tiers = F.array(*[F.lit(t) for t in LOYALTY_TIERS])
    step = F.least(F.array_position(tiers, F.col("loyalty_tier")), F.lit(3)).cast("int")
    return bronze_customers(spark, sf_dir).withColumns(
        {
            "loyalty_tier": F.when(ck % 23 == 1, F.element_at(tiers, step + 1)).otherwise(F.col("loyalty_tier")),
            "total_lifetime_spend": (
                F.col("total_lifetime_spend") + F.when(ck % 23 == 2, 500).otherwise(0)
            ).cast("decimal(12,2)"),
            "is_active": F.col("is_active") & (ck % 29 != 5),
        }
    )


def customer_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery: BUILDING customers again, FURNITURE ones under a new id.

    Balances below 2500 arrive twice; ``arrival`` orders the records of a key.
    """
    ck, spend = F.col("c_custkey"), F.col("c_acctbal").cast("decimal(12,2)") * 10
    known = F.col("c_mktsegment") == "BUILDING"
    feed = customer_feed(spark, sf_dir).drop("loyalty_tier", "total_lifetime_spend", "is_active", "first_name")
    records = (
        table(spark, sf_dir, "customer")
        .filter(known | (F.col("c_mktsegment") == "FURNITURE"))
        .withColumn("arrival", F.explode(F.sequence(F.lit(1), F.when(F.col("c_acctbal") < 2500, 2).otherwise(1))))
        .select(
            F.concat(F.lit("CUST"), ck).alias("customer_id"),
            F.when(known, "").otherwise("N").alias("_new"),
            F.concat(F.lit("Customer"), F.col("arrival")).alias("first_name"),
            pick(LOYALTY_TIERS, F.least(tier_index(F.col("c_acctbal")) + F.col("arrival"), F.lit(3))).alias(
                "loyalty_tier"
            ),
            (spend + F.col("arrival") * 100).cast("decimal(12,2)").alias("total_lifetime_spend"),
            (F.col("arrival") == 1).alias("is_active"),
            "arrival",
        )
    )
    return (
        feed.join(records, "customer_id")
        .withColumn("customer_id", F.concat(F.lit("CUST"), "_new", F.substring("customer_id", 5, 50)))
        .drop("_new")
    )


# ---------------------------------------------------------------- orders

#: Arrival order of the records that share an order id.
ORDER_ARRIVAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def order_feed(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """One record per order line; a few ids repeat, as re-sent records do.

    ``lines`` replaces the whole line table, for instance by one micro-batch of it.
    """
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part").select("p_partkey", list_price(F.col("p_retailprice")).alias("unit_price"))
    line = table(spark, sf_dir, "lineitem") if lines is None else lines
    ck, pk = F.col("o_custkey"), F.col("l_partkey")
    points = F.round(F.col("l_discount") * 100).cast("int")
    promo = (
        F.when(points < 5, F.lit(None)).when(points < 7, "SAVE10").when(points == 7, "FLASH20")
        .when(points == 8, "NEW50").otherwise("WEEK15")
    )
    status = (
        F.when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("l_linenumber") == 7), "on_hold")
        .when(ck % 25 == 24, "pending")
        .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "cancelled")
        .when((F.col("o_orderstatus") == "P") & (F.col("l_returnflag") == "N"), "pending")
        .otherwise("completed")
    )
    placed = F.col("o_orderdate") + F.make_dt_interval(
        F.lit(0), (F.col("l_orderkey") % 24).cast("int"), (F.col("l_linenumber") * 7).cast("int"), F.lit(0)
    )
    records = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, pk == F.col("p_partkey"))
        .select(
            F.concat(F.lit("ORD"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("order_id"),
            F.concat(F.when(ck % 97 == 96, "GUEST").otherwise("CUST"), ck).alias("customer_id"),
            F.when(F.col("l_suppkey") % 89 == 88, -pk - 1).otherwise(pk).cast("int").alias("product_id"),
            F.when(pk % 101 == 100, 0).otherwise(F.col("l_quantity")).cast("int").alias("quantity"),
            "unit_price",
            placed.alias("order_timestamp"),
            status.alias("status"),
            F.lower("o_orderpriority").alias("payment_method"),
            promo.cast("string").alias("promo_code"),
            F.concat(ck, F.lit(" Market Road")).alias("shipping_address"),
            "l_returnflag",
            *ORDER_ARRIVAL,
        )
    )
    return order_amounts(records, "unit_price", "quantity", "promo_code", PROMO_PERCENT)


def order_arrival() -> list[Column]:
    return [smallest_first(c) for c in ORDER_ARRIVAL]


# ---------------------------------------------------------------- inventory


def bronze_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots (0, 7 and 30 days back) of every product.

    The smaller a part, the more of it is kept; it is ordered in sixes, and one more for each letter of its type. The margin on
    the list price grows with the length of the type's name and with the size, whole cents rounded down.
    """
    pk = F.col("p_partkey")
    price = list_price(F.col("p_retailprice"))
    lag = F.col("days_back")
    reorder = (F.lit(56) - F.col("p_size")).cast("int")
    quantity = (F.expr("(56 - p_size) div 6 + 1") * 6 + F.length("p_type")).cast("int")
    cents, margin = (price * 100).cast("long"), F.length("p_type") * 2 + F.expr("p_size div 5") + 15
    stock = (
        F.when((pk % 97 == 13) | ((pk % 41 == 5) & (lag == 0)), -1)
        .when(pk % 50 == 0, 0)
        .otherwise((pk * 31 + lag * 17) % 500)
    )
    paid = (cents - F.floor(cents * margin / F.lit(100))).cast("decimal(12,0)") / F.lit(100)
    cost = F.when(pk % 43 != 11, paid.cast("decimal(10,2)"))
    records = (
        table(spark, sf_dir, "part")
        .withColumn("days_back", F.explode(F.array(*[F.lit(d) for d in (0, 7, 30)])))
        .select(
            F.xxhash64("p_partkey", "days_back").alias("inventory_id"),
            pk.cast("int").alias("product_id"),
            stock.cast("int").alias("stock_quantity"),
            F.concat_ws(" ", F.lit("Depot"), "p_brand").alias("warehouse_location"),
            reorder.alias("reorder_point"),
            quantity.alias("reorder_quantity"),
            cost.alias("cost_price"),
            F.concat(F.lit("Supplier "), pk % 10).alias("supplier_name"),
            F.date_sub(day(AS_OF), (lag + pk % 15).cast("int")).alias("last_restock_date"),
            F.date_sub(day(AS_OF), lag).alias("inventory_date"),
        )
    )
    return with_lineage(records, "inventory_feed", "load-1", F.col("inventory_date"))


# ---------------------------------------------------------------- campaigns


def campaign_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One campaign per supplier, in the channel of its region."""
    k = F.col("s_suppkey")
    place = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    pct = pick(tuple(p for _, p in CAMPAIGN_CODES), k % len(CAMPAIGN_CODES))
    code = pick(tuple(c for c, _ in CAMPAIGN_CODES), k % len(CAMPAIGN_CODES))
    start = F.date_sub(day(AS_OF), (60 - (k * 11 + pct) % 50).cast("int"))
    budget = F.when(k % 29 == 15, 0).otherwise(F.pow(F.lit(4), k % 7).cast("int") * 1000 + pct * 10)
    return (
        table(spark, sf_dir, "supplier")
        .join(place, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("CAMP"), k).alias("campaign_id"),
            F.concat_ws(" ", "n_name", "s_name").alias("campaign_name"),
            F.col("r_name").alias("channel"),
            F.coalesce(code, F.concat(F.lit("OWN"), k)).alias("promo_code"),
            pct.cast("int").alias("discount_percentage"),
            start.alias("start_date"),
            F.date_add(start, (F.lit(3) + (k * 7 + pct) % 28).cast("int")).alias("end_date"),
            budget.cast("decimal(12,2)").alias("budget"),
            (budget * F.lit("0.9").cast("decimal(2,1)")).cast("decimal(12,2)").alias("actual_spend"),
        )
    )


def bronze_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_lineage(campaign_feed(spark, sf_dir), "campaign_feed", "load-1", midnight(FIRST_DAY))


def campaign_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery of all campaigns: higher spend, changed name; plus ids not seen before."""
    again = campaign_feed(spark, sf_dir).withColumns(
        {
            "actual_spend": F.round(F.col("actual_spend") * F.lit(110) / 100, 2).cast("decimal(12,2)"),
            "campaign_name": F.concat("campaign_name", F.lit(" (renamed)")),
            "campaign_id": F.explode(
                F.when(F.col("promo_code") == "WEEK15", F.array(F.col("campaign_id"), F.concat("campaign_id", F.lit("-B"))))
                .otherwise(F.array("campaign_id"))
            ),
        }
    )
    return with_lineage(again, "campaign_feed", "load-2", midnight(AS_OF))
