"""The registered queries: each runs library operators over the derived feeds."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet import schemas
from martlet.functions import labels
from martlet.functions.ordering import SortKey
from martlet.operators.history import scd2_apply, scd2_as_of, scd2_changes
from martlet.operators.joins import interval_join
from martlet.operators.quality import failed_rules, gate, unique_on, with_known_flag
from martlet.operators.quality import ri_coverage as coverage
from martlet.operators.ranking import global_rank, rank_within
from martlet.plans import bronze, extended, gold, silver, visitors
from martlet.plans.refresh import CUSTOMER_HISTORY, PRODUCT_HISTORY, full_marts, price_reason, refresh, tier_reason
from martlet.session import dropped, scratch_path, stored, tune
from martlet.sources import feeds, star
from martlet.sources.keyed import KeyedTable, MergedTable
from martlet.sources.star import AS_OF, FIRST_DAY
from martlet.sources.tables import Tables
from martlet.streaming import ingest, revenue


class Lake:
    """The bronze and clean tables of one scale factor, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = tune(spark), sf_dir

    @cached_property
    def products(self) -> DataFrame:
        return star.bronze_products(self.spark, self.sf)

    @cached_property
    def customers(self) -> DataFrame:
        return star.bronze_customers(self.spark, self.sf)

    @cached_property
    def customer_keys(self) -> DataFrame:
        return star.customer_keys(self.spark, self.sf)

    @cached_property
    def order_feed(self) -> DataFrame:
        return star.order_feed(self.spark, self.sf)

    @cached_property
    def orders(self) -> DataFrame:
        return bronze.new_orders(None, self.order_feed, star.order_arrival())

    @cached_property
    def inventory(self) -> DataFrame:
        return star.bronze_inventory(self.spark, self.sf)

    @cached_property
    def campaigns(self) -> DataFrame:
        return star.bronze_campaigns(self.spark, self.sf)

    @cached_property
    def clean_products(self) -> DataFrame:
        return silver.silver_products(self.products)[0]

    @cached_property
    def first_products(self) -> DataFrame:
        return silver.silver_products(star.bronze_products(self.spark, self.sf, (1,)))[0]

    @cached_property
    def second_products(self) -> DataFrame:
        return silver.silver_products(star.bronze_products(self.spark, self.sf, (2,)))[0]

    @cached_property
    def clean_customers(self) -> DataFrame:
        return silver.silver_customers(self.customers, AS_OF)[0]

    @cached_property
    def clean_orders(self) -> DataFrame:
        return silver.clean_orders(self.orders, self.customer_keys, self.products)

    @cached_property
    def clean_inventory(self) -> DataFrame:
        return silver.silver_inventory(self.inventory)[0]

    @cached_property
    def clean_campaigns(self) -> DataFrame:
        return silver.silver_campaigns(self.campaigns, AS_OF)[0]

    @cached_property
    def two_runs(self) -> tuple[Tables, dict[str, dict[str, int]]]:
        """The daily run over two deliveries, once per session: its tables, and the counts of each run."""
        tables = Tables(self.spark, scratch_path(self.spark, "two-runs"))
        arrival = {"orders": star.order_arrival(), "customers": ["signup_date"], "campaigns": ["ingestion_timestamp"]}
        deliveries = {
            "day-1": (FIRST_DAY, 1, self.customers, self.campaigns),
            "day-2": (AS_OF, 2, star.bronze_customers_later(self.spark, self.sf), star.campaign_batch(self.spark, self.sf)),
        }
        counts = {}
        for run_id, (as_of, delivery, customers, campaigns) in deliveries.items():
            delivered = {
                "products": star.bronze_products(self.spark, self.sf, (delivery,)), "customers": customers,
                "orders": self.order_feed, "inventory": self.inventory, "campaigns": campaigns,
            }
            counts[run_id] = refresh(tables, delivered, as_of, run_id, arrival)
        return tables, counts

    # Histories: the first day, then the as-of day.

    def no_history(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], schemas.struct_type(table))

    @cached_property
    def price_history_first(self) -> DataFrame:
        empty = self.no_history("product_price_history")
        active = self.first_products.filter("is_active")
        return scd2_apply(empty, active, as_of=FIRST_DAY, reason=price_reason, **PRODUCT_HISTORY)

    @cached_property
    def price_history(self) -> DataFrame:
        active = self.clean_products.filter("is_active")
        return scd2_apply(self.price_history_first, active, as_of=AS_OF, reason=price_reason, **PRODUCT_HISTORY)

    @cached_property
    def tier_history_first(self) -> DataFrame:
        empty = self.no_history("customer_tier_history")
        active = silver.silver_customers(self.customers, FIRST_DAY)[0].filter("is_active")
        return scd2_apply(empty, active, as_of=FIRST_DAY, reason=tier_reason, **CUSTOMER_HISTORY)

    @cached_property
    def later_customers(self) -> DataFrame:
        later = star.bronze_customers_later(self.spark, self.sf)
        return silver.silver_customers(later, AS_OF)[0].filter("is_active")

    @cached_property
    def tier_history(self) -> DataFrame:
        return scd2_apply(
            self.tier_history_first, self.later_customers, as_of=AS_OF, reason=tier_reason, **CUSTOMER_HISTORY
        )


def publish(df: DataFrame) -> DataFrame:
    """Comparable output types: decimals as double, integers as bigint, times and arrays as text."""
    def shown(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", F.array_sort(c))
        return c.alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}


def query(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- sources and sinks


@query
def bronze_products_flatten(x: Lake) -> DataFrame:
    return x.products


@query
def product_lookup(x: Lake) -> DataFrame:
    return feeds.product_lookup(x.clean_products, 42)


@query
def product_categories(x: Lake) -> DataFrame:
    return feeds.product_categories(x.products)


@query
def raw_json_extract(x: Lake) -> DataFrame:
    """Payload kept as JSON, then read back field by field."""
    kept = feeds.with_raw_json(star.product_feed(x.spark, x.sf, 1)).select("raw_json")
    path = lambda p: F.get_json_object("raw_json", p)
    return kept.select(
        path("$.id").cast("bigint").alias("product_id"),
        path("$.title").alias("title"),
        path("$.price").cast("double").alias("price"),
        path("$.rating.rate").cast("double").alias("rating_rate"),
        path("$.rating.count").cast("bigint").alias("rating_count"),
    )


#: Records of one file of a text feed.
FEED_FILE_RECORDS = 500_000


def _delivered(x: Lake, name: str, feed: DataFrame, fmt: str) -> DataFrame:
    """A feed written as files and read back through the typed reader."""
    path = scratch_path(x.spark, f"{name}-{fmt}")
    writer = feed.write.format(fmt).option("header", "true")
    if fmt in ("json", "csv"):  # text is several times its packed size; a packed file is read by one task, so its records are bounded
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", FEED_FILE_RECORDS)
    writer.save(path)
    return feeds.read_feed(x.spark, name, path, fmt)


@query
def product_feed_json(x: Lake) -> DataFrame:
    read = _delivered(x, "products", star.product_feed(x.spark, x.sf, 1), "json")
    return feeds.flatten_products(read).select(
        "product_id", "title", "price", "description", "category", "image_url", "rating_rate", "rating_count"
    )


@query
def customer_feed_csv(x: Lake) -> DataFrame:
    read = _delivered(x, "customers", star.customer_feed(x.spark, x.sf), "csv")
    return read.select("customer_id", "last_name", "email", "city", "signup_date", "loyalty_tier",
                       "total_lifetime_spend", "is_active")


@query
def order_feed_json(x: Lake) -> DataFrame:
    """Order times travel as ISO text and arrive as timestamps."""
    read = _delivered(x, "orders", x.orders.drop("l_returnflag", *star.ORDER_ARRIVAL), "json")
    return read.select("order_id", "customer_id", "product_id", "quantity", "final_amount", "order_timestamp", "status",
                       "promo_code")


@query
def inventory_feed_csv(x: Lake) -> DataFrame:
    columns = feeds.feed_schema("inventory").fieldNames()
    return _delivered(x, "inventory", x.inventory.select(*columns), "csv").select(
        "product_id", "stock_quantity", "warehouse_location", "reorder_point", "reorder_quantity", "cost_price",
        "inventory_date",
    )


@query
def feed_rescued_lines(x: Lake) -> DataFrame:
    """An inventory feed in which some lines are cut off: the records that were read, and the lines that were rescued."""
    names, path = feeds.feed_schema("inventory").fieldNames(), scratch_path(x.spark, "inventory-lines")
    whole = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    cut = F.concat_ws(",", "product_id", "stock_quantity")
    x.inventory.select(F.when(F.col("product_id") % 50 == 7, cut).otherwise(whole).alias("value")).write.text(path)
    records, rescued = feeds.split_feed(x.spark, "inventory", path, "csv", header="false")
    rejects = feeds.rescued_rejects(rescued, "inventory")
    kept = records.select("product_id", "inventory_date", "stock_quantity", F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason"))
    lost = rejects.select(
        *[F.lit(None).cast(t).alias(c) for c, t in (("product_id", "int"), ("inventory_date", "date"), ("stock_quantity", "int"))],
        F.col("record_key").alias("line"), F.col("reasons")[0].alias("reason"),
    )
    return kept.unionByName(lost)


@query
def campaign_feed_orc(x: Lake) -> DataFrame:
    return _delivered(x, "campaigns", star.campaign_feed(x.spark, x.sf), "orc")


@query
def user_feed_json(x: Lake) -> DataFrame:
    """Nested user records, delivered as JSON."""
    read = _delivered(x, "users", star.user_feed(x.spark, x.sf), "json")
    return read.select("id", "email", "username", "name.firstname", "name.lastname", "phone", "address.city", "address.number",
                       "address.zipcode")


@query
def surrogate_keys(x: Lake) -> DataFrame:
    """Row ids of the price history: hashes of the natural key, equal in every run."""
    ids = x.price_history.select("product_id", "valid_from", F.xxhash64("product_id", "valid_from").alias("id"))
    return ids.groupBy("valid_from").agg(F.count("*").alias("n"), F.countDistinct("id").alias("n_ids"))


@query
def order_text_parse(x: Lake) -> DataFrame:
    """Dates that arrive as ISO text; the unparsable ones become NULL."""
    spoiled = F.when(F.col("status") == "on_hold", F.lit("not a time")).otherwise(
        F.date_format("order_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    )
    text = x.orders.select("order_id", spoiled.alias("order_timestamp"))
    parsed = feeds.parse_iso(text, timestamps=["order_timestamp"])
    return parsed.select("order_id", "order_timestamp")


@query
def source_filename(x: Lake) -> DataFrame:
    """Records per input table file, by its name: the folder depends on where the tables lie."""
    line = feeds.with_filename(star.table(x.spark, x.sf, "lineitem").select("l_orderkey", "_metadata"))
    table_file = F.regexp_extract("source_filename", r"([^/]+\.parquet)(/part-[^/]*)?$", 1)
    return line.groupBy(table_file.alias("source_filename")).agg(F.count("*").alias("n"))


@query
def inventory_append(x: Lake) -> DataFrame:
    """Snapshots appended load by load; a repeated load replaces itself."""
    tables = Tables(x.spark, scratch_path(x.spark, "append"))
    for load in ("load-1", "load-2", "load-2"):
        days = x.inventory.filter(
            (F.col("inventory_date") == F.lit(AS_OF)) == F.lit(load == "load-2")
        )
        tables.append("bronze_inventory", days, load, ("inventory_date",))
    return tables.read_appended("bronze_inventory").groupBy("inventory_date").agg(
        F.count("*").alias("n"), F.sum("stock_quantity").alias("stock"), F.countDistinct("load_id").alias("loads")
    )


@query
def products_full_refresh(x: Lake) -> DataFrame:
    """A table replaced twice; readers see the newest complete version."""
    tables = Tables(x.spark, scratch_path(x.spark, "refresh"))
    tables.overwrite("silver_products", x.first_products)
    tables.overwrite("silver_products", x.clean_products)
    return tables.read("silver_products").groupBy("price_tier").agg(
        F.count("*").alias("n"), F.sum("price").alias("price_sum")
    )


@query
def load_counts(x: Lake) -> DataFrame:
    """Rows accepted and rejected per clean table."""
    splits = {
        "silver_products": silver.silver_products(x.products),
        "silver_customers": silver.silver_customers(x.customers, AS_OF),
        "silver_inventory": silver.silver_inventory(x.inventory),
        "silver_campaigns": silver.silver_campaigns(x.campaigns, AS_OF),
    }
    parts = [
        side.select(F.lit(table).alias("table_name"), F.lit(label).alias("outcome"))
        for table, pair in splits.items()
        for label, side in zip(("accepted", "rejected"), pair)
    ]
    judged = silver.judged_orders(x.orders, x.customer_keys, x.products)
    outcome = F.when(F.size("reasons") > 0, "rejected").otherwise("accepted")
    together = judged.select(F.lit("silver_orders").alias("table_name"), outcome.alias("outcome"))
    for part in parts:
        together = together.unionAll(part)
    return together.groupBy("table_name", "outcome").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- merges


@query
def orders_insert_ignore(x: Lake) -> DataFrame:
    """A first load, then the same feed again: only unseen ids are added."""
    first = bronze.new_orders(None, x.order_feed.filter("l_returnflag <> 'N'"), star.order_arrival())
    added = bronze.new_orders(first, x.order_feed, star.order_arrival())
    return first.unionByName(added).select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "discount_amount",
        "final_amount", "status", "promo_code",
    )


@query
def products_insert_ignore(x: Lake) -> DataFrame:
    """The first delivery, then both again: only versions of an unseen (product, time) are added."""
    first = bronze.new_product_versions(None, star.bronze_products(x.spark, x.sf, (1,)))
    added = bronze.new_product_versions(first, x.products.unionByName(x.products))
    return first.withColumn("load", F.lit(1)).unionByName(added.withColumn("load", F.lit(2))).select(
        "product_id", "title", "price", "ingestion_timestamp", "load"
    )


@query
def customers_upsert(x: Lake) -> DataFrame:
    merged = bronze.merge_customers(
        x.customers, star.customer_batch(x.spark, x.sf), ["arrival"], star.midnight(AS_OF)
    )
    return merged.select(
        "customer_id", "first_name", "last_name", "email", "signup_date", "loyalty_tier", "total_lifetime_spend",
        "is_active", F.col("last_modified_date").isNotNull().alias("modified"),
    )


@query
def campaigns_upsert(x: Lake) -> DataFrame:
    return bronze.merge_campaigns(x.campaigns, star.campaign_batch(x.spark, x.sf), ["ingestion_timestamp"]).select(
        "campaign_id", "campaign_name", "actual_spend", "ingestion_timestamp", "pipeline_run_id"
    )


@query
def products_upsert(x: Lake) -> DataFrame:
    """Clean products of the first delivery, merged with those of the second."""
    return silver.merge("silver_products", x.first_products, x.second_products)


@query
def clean_customers_upsert(x: Lake) -> DataFrame:
    first = silver.silver_customers(x.customers, FIRST_DAY)[0]
    later = silver.silver_customers(star.bronze_customers_later(x.spark, x.sf), AS_OF)[0]
    stored = schemas.stamped(first, "silver_customers", star.midnight(FIRST_DAY))
    return silver.merge("silver_customers", stored, later, star.midnight(AS_OF)).select(
        "customer_id", "full_name", "loyalty_tier", "total_lifetime_spend", "is_active", "customer_age_days",
        "customer_segment", "created_at", "updated_at", "source_table",
    )


@query
def clean_campaigns_upsert(x: Lake) -> DataFrame:
    first = silver.silver_campaigns(x.campaigns, FIRST_DAY)[0]
    later = silver.silver_campaigns(star.campaign_batch(x.spark, x.sf), AS_OF)[0]
    return silver.merge("silver_campaigns", first, later)


@query
def orders_status_upsert(x: Lake) -> DataFrame:
    """Returned lines come back as refunded with other amounts; only the status may change."""
    returned = bronze.new_orders(None, x.order_feed.filter("l_returnflag = 'R'"), star.order_arrival()).withColumns(
        {"status": F.lit("refunded"), "final_amount": F.lit(0).cast("decimal(10,2)")}
    )
    batch = silver.clean_orders(returned, x.customer_keys, x.products)
    return silver.merge("silver_orders", x.clean_orders, batch).select(
        "order_id", "status", "quantity", "total_amount", "final_amount"
    )


# ---------------------------------------------------------------- quality


@query
def dq_products_price(x: Lake) -> DataFrame:
    _, rejected = gate(x.products, {"price_positive": F.col("price") > 0})
    return rejected.select("product_id", "price", "ingestion_timestamp", "reasons")


@query
def dq_customers_email(x: Lake) -> DataFrame:
    _, rejected = gate(x.customers, {"email_valid": labels.valid_email(F.col("email"))})
    return rejected.select("customer_id", "email", "reasons")


@query
def dq_orders_positive(x: Lake) -> DataFrame:
    rules = {"quantity_positive": F.col("quantity") > 0, "unit_price_positive": F.col("unit_price") > 0}
    _, rejected = gate(x.orders, rules)
    return rejected.select("order_id", "quantity", "unit_price", "reasons")


@query
def dq_orders_referential(x: Lake) -> DataFrame:
    """Every order with the outcome of both existence tests, in one pass of the orders."""
    flagged = with_known_flag(x.orders, x.customer_keys, "customer_id", "known_customer")
    flagged = with_known_flag(flagged, x.products, "product_id", "known_product")
    outcome = F.when(~F.col("known_customer"), "customer_unknown").when(~F.col("known_product"), "product_unknown")
    return flagged.select("order_id", "customer_id", "product_id", outcome.otherwise("known").alias("outcome"))


@query
def dq_orders_status(x: Lake) -> DataFrame:
    _, rejected = gate(x.orders, {"status_allowed": F.col("status").isin(*labels.ORDER_STATUSES)})
    return rejected.select("order_id", "status")


@query
def dq_inventory_stock(x: Lake) -> DataFrame:
    _, rejected = gate(x.inventory, {"stock_not_negative": F.col("stock_quantity") >= 0})
    return rejected.select("product_id", "inventory_date", "stock_quantity")


@query
def dq_schema_rules(x: Lake) -> DataFrame:
    """Required, length and check rules of clean inventory, counted per broken rule."""
    latest = silver.latest_inventory(x.inventory)
    rules = schemas.schema_rules("silver_inventory", latest.columns)
    broken = latest.select(F.explode(failed_rules(rules)).alias("rule"))
    return broken.groupBy("rule").agg(F.count("*").alias("n"))


@query
def dq_customers_duplicate_email(x: Lake) -> DataFrame:
    """Customers after the second delivery that repeat an e-mail of a smaller id."""
    merged = bronze.merge_customers(
        x.customers, star.customer_batch(x.spark, x.sf), ["arrival"], star.midnight(AS_OF)
    ).select("customer_id", F.lower("email").alias("email"))
    _, repeated = unique_on(merged, ["email"], keep="customer_id")
    return repeated


@query
def dq_order_rejects(x: Lake) -> DataFrame:
    return silver.rejected_orders(x.orders, x.customer_keys, x.products)


@query
def dq_customer_rejects(x: Lake) -> DataFrame:
    return silver.silver_customers(x.customers, AS_OF)[1]


@query
def ri_coverage(x: Lake) -> DataFrame:
    return coverage(x.orders, x.customer_keys, "customer_id")


# ---------------------------------------------------------------- clean tables


@query
def latest_products(x: Lake) -> DataFrame:
    return silver.latest_products(x.products).select("product_id", "title", "price", "ingestion_timestamp")


@query
def latest_inventory(x: Lake) -> DataFrame:
    return silver.latest_inventory(x.inventory).select("product_id", "stock_quantity", "inventory_date")


@query
def silver_products(x: Lake) -> DataFrame:
    return x.clean_products


@query
def silver_customers(x: Lake) -> DataFrame:
    return x.clean_customers


@query
def silver_orders(x: Lake) -> DataFrame:
    return x.clean_orders


@query
def silver_inventory(x: Lake) -> DataFrame:
    return x.clean_inventory


@query
def silver_campaigns(x: Lake) -> DataFrame:
    return x.clean_campaigns


@query
def product_price_tier(x: Lake) -> DataFrame:
    return x.clean_products.groupBy("price_tier").agg(
        F.count("*").alias("n"), F.min("price").alias("min_price"), F.max("price").alias("max_price")
    )


@query
def product_quality_score(x: Lake) -> DataFrame:
    return x.clean_products.select("product_id", "data_quality_score")


@query
def customer_lifecycle_segment(x: Lake) -> DataFrame:
    return x.clean_customers.select("customer_id", "full_name", "customer_age_days", "customer_segment")


@query
def order_time_parts(x: Lake) -> DataFrame:
    return x.clean_orders.select(
        "order_id", "order_date", "order_time", "order_hour", "order_day_of_week", "is_weekend", "is_discounted"
    )


@query
def order_amounts(x: Lake) -> DataFrame:
    return x.order_feed.groupBy("promo_code").agg(
        F.count("*").alias("n"),
        F.sum("total_amount").alias("total"),
        F.sum("discount_amount").alias("discount"),
        F.sum("final_amount").alias("final"),
    )


@query
def inventory_stock_status(x: Lake) -> DataFrame:
    return x.clean_inventory.select("product_id", "stock_status", "inventory_value")


@query
def campaign_active_flag(x: Lake) -> DataFrame:
    return x.clean_campaigns.select("campaign_id", "is_active")


# ---------------------------------------------------------------- marts


@query
def daily_revenue(x: Lake) -> DataFrame:
    return gold.daily_revenue(x.clean_orders)


@query
def revenue_growth(x: Lake) -> DataFrame:
    return gold.daily_revenue(x.clean_orders).select(
        "revenue_date", "total_revenue", "revenue_vs_previous_day", "revenue_growth_pct"
    )


@query
def order_status_counts(x: Lake) -> DataFrame:
    return gold.daily_totals(x.clean_orders).select(
        "revenue_date", "completed_orders", "pending_orders", "cancelled_orders", "cancellation_rate",
        "promo_usage_rate",
    )


@query
def unique_customers_per_day(x: Lake) -> DataFrame:
    return gold.daily_totals(x.clean_orders).select("revenue_date", "unique_customers", "total_orders")


@query
def unique_customers_by_period(x: Lake) -> DataFrame:
    """Customers of every day, month and quarter, counted out of stored bitmaps of the days."""
    root = scratch_path(x.spark, "visitors")
    orders = x.clean_orders.select("order_date", "customer_id")
    visitors.customer_numbers(orders).write.parquet(f"{root}/numbers")
    visitors.day_bitmaps(orders, x.spark.read.parquet(f"{root}/numbers")).write.parquet(f"{root}/days")
    return visitors.customers_by_period(x.spark.read.parquet(f"{root}/days"))


@query
def product_performance(x: Lake) -> DataFrame:
    return gold.product_performance(x.clean_products, x.clean_orders, x.clean_inventory, AS_OF)


@query
def product_overall_rank(x: Lake) -> DataFrame:
    """The rank of every product by revenue."""
    totals = gold.product_totals(x.clean_products, x.clean_orders, x.clean_inventory, AS_OF)
    by_revenue = SortKey("total_revenue", descending=True)
    return global_rank(
        totals.select("product_id", "total_revenue"), by_revenue, "product_id", "overall_rank"
    )


@query
def product_category_rank(x: Lake) -> DataFrame:
    """The rank of every product in its category."""
    totals = gold.product_totals(x.clean_products, x.clean_orders, x.clean_inventory, AS_OF)
    by_revenue = SortKey("total_revenue", descending=True)
    return rank_within(
        totals.select("product_id", "category", "total_revenue"), ["category"], by_revenue, "product_id",
        "category_rank",
    )


@query
def customer_order_totals(x: Lake) -> DataFrame:
    return gold.customer_order_totals(x.clean_customers, x.clean_orders).drop("full_name", "email", "signup_date")


@query
def rfm_scores(x: Lake) -> DataFrame:
    """Every customer's three tiles."""
    return gold.rfm_scores(x.clean_customers, x.clean_orders, AS_OF).select(
        "customer_id", "days_since_last_order", "total_orders", "total_lifetime_value",
        "recency_score", "frequency_score", "monetary_score",
    )


@query
def customer_rfm(x: Lake) -> DataFrame:
    return gold.customer_rfm(x.clean_customers, x.clean_orders, AS_OF)


@query
def customer_rfm_conventional(x: Lake) -> DataFrame:
    scored = gold.customer_rfm(x.clean_customers, x.clean_orders, AS_OF, score_direction="conventional")
    return scored.select("customer_id", "rfm_combined_score", "customer_segment")


@query
def customer_segment_counts(x: Lake) -> DataFrame:
    return gold.customer_rfm(x.clean_customers, x.clean_orders, AS_OF).groupBy("customer_segment").agg(
        F.count("*").alias("n"), F.sum("total_lifetime_value").alias("total_lifetime_value")
    )


@query
def churn_risk(x: Lake) -> DataFrame:
    return gold.customer_rfm(x.clean_customers, x.clean_orders, AS_OF).groupBy("churn_risk").agg(
        F.count("*").alias("n"), F.min("days_since_last_order").alias("min_days"),
        F.max("days_since_last_order").alias("max_days"),
    )


@query
def inventory_health(x: Lake) -> DataFrame:
    return gold.inventory_health(x.clean_inventory, x.clean_products, x.clean_orders, AS_OF)


@query
def dead_stock(x: Lake) -> DataFrame:
    return gold.dead_stock(x.clean_inventory, x.clean_orders, AS_OF).select("product_id", "stock_quantity")


@query
def campaign_order_match(x: Lake) -> DataFrame:
    """Campaigns with the days their code was used; campaigns without a match keep one row."""
    matched = gold.campaign_days(x.clean_campaigns, x.clean_orders, how="left")
    return matched.select("campaign_id", "order_date", "n_orders", "revenue")


@query
def campaign_interval_join(x: Lake) -> DataFrame:
    """The interval join on single orders, not aggregated ones."""
    frame = x.clean_campaigns.select("campaign_id", F.col("promo_code").alias("code"), "start_date", "end_date")
    facts = x.clean_orders.select("order_id", F.col("promo_code").alias("code"), "order_date", "status")
    return interval_join(facts, frame, "code", "order_date", "start_date", "end_date").select(
        "campaign_id", "order_id", "order_date", "status"
    )


@query
def campaign_roi(x: Lake) -> DataFrame:
    return gold.campaign_roi(x.clean_campaigns, x.clean_orders, AS_OF)


@query
def campaign_rank(x: Lake) -> DataFrame:
    """The rank of every campaign, NULL returns first."""
    totals = gold.campaign_totals(x.clean_campaigns, x.clean_orders).select("campaign_id", "roi")
    return global_rank(totals, SortKey("roi", descending=True), "campaign_id", "campaign_rank")


# ---------------------------------------------------------------- history


@query
def scd_product_initial(x: Lake) -> DataFrame:
    return x.price_history_first


@query
def scd_product_apply(x: Lake) -> DataFrame:
    return x.price_history


@query
def scd_customer_apply(x: Lake) -> DataFrame:
    return x.tier_history


@query
def scd_change_counts(x: Lake) -> DataFrame:
    products = scd2_changes(
        x.price_history_first, x.clean_products.filter("is_active"), "product_id", PRODUCT_HISTORY["tracked"]
    )
    customers = scd2_changes(
        x.tier_history_first, x.later_customers, "customer_id", CUSTOMER_HISTORY["tracked"]
    )
    return products.withColumn("dimension", F.lit("product")).unionByName(
        customers.withColumn("dimension", F.lit("customer"))
    )


@query
def price_as_of(x: Lake) -> DataFrame:
    """Every inventory snapshot with the price that was valid on its day."""
    versions = x.price_history.select("product_id", "price", "price_tier", "valid_from", "valid_to")
    fact = x.inventory.select("product_id", "inventory_date", "stock_quantity")
    return scd2_as_of(versions, fact, "product_id", "inventory_date")


@query
def tier_as_of(x: Lake) -> DataFrame:
    """Every clean order with the loyalty tier its customer had on the day, if recorded."""
    versions = x.tier_history.select("customer_id", "loyalty_tier", "valid_from", "valid_to")
    fact = x.clean_orders.select("order_id", "customer_id", "order_date")
    return scd2_as_of(versions, fact, "customer_id", "order_date").select(
        "order_id", "customer_id", "order_date", "loyalty_tier"
    )


# ---------------------------------------------------------------- declared measures


@query
def daily_new_returning(x: Lake) -> DataFrame:
    return extended.daily_new_returning(x.clean_orders)


@query
def product_stock_stats(x: Lake) -> DataFrame:
    return extended.product_stock_stats(x.inventory, x.clean_orders, AS_OF)


@query
def repeat_purchase_rate(x: Lake) -> DataFrame:
    return extended.repeat_purchase_rate(x.clean_orders)


@query
def product_period_growth(x: Lake) -> DataFrame:
    return extended.product_period_growth(x.clean_orders, AS_OF)


@query
def segment_advice(x: Lake) -> DataFrame:
    segments = gold.customer_rfm(x.clean_customers, x.clean_orders, AS_OF).select("customer_id", "customer_segment")
    return extended.segment_advice(segments)


@query
def next_purchase_days(x: Lake) -> DataFrame:
    return extended.next_purchase_days(x.clean_orders, AS_OF)


@query
def inventory_cover(x: Lake) -> DataFrame:
    return extended.inventory_cover(x.clean_inventory, x.clean_orders, AS_OF)


@query
def reorder_advice(x: Lake) -> DataFrame:
    return extended.reorder_advice(silver.latest_inventory(x.inventory))


@query
def stock_change(x: Lake) -> DataFrame:
    return extended.stock_change(x.inventory, silver.latest_inventory(x.inventory))


@query
def campaign_acquisition(x: Lake) -> DataFrame:
    return extended.campaign_acquisition(x.clean_campaigns, x.clean_orders, x.clean_inventory)


@query
def revenue_yoy(x: Lake) -> DataFrame:
    return extended.revenue_yoy(gold.daily_totals(x.clean_orders))


@query
def weekend_pattern(x: Lake) -> DataFrame:
    return extended.weekend_pattern(x.clean_orders)


# ---------------------------------------------------------------- stored marts


def _stored(x: Lake, name: str) -> Tables:
    """The clean tables written out, as a daily run would find them."""
    tables = Tables(x.spark, scratch_path(x.spark, name))
    # Packed files in between, so that what finding the first records has moved is gone before they move on to customers and products.
    orders = stored(x.orders.select(*schemas.column_names("pending_orders")), "first-orders")
    for table, clean in {
        "silver_products": x.clean_products, "silver_customers": x.clean_customers,
        "silver_orders": silver.with_month(silver.clean_orders(orders, x.customer_keys, x.products)),
        "silver_inventory": x.clean_inventory, "silver_campaigns": x.clean_campaigns,
    }.items():
        tables.overwrite(table, clean)
    dropped(x.spark, orders.inputFiles())
    tables.append("bronze_inventory", x.inventory, "load-1", ("inventory_date",))
    return tables


@query
def mart_row_counts(x: Lake) -> DataFrame:
    """All five marts with every declared column, built from stored clean tables and stored in turn."""
    tables = _stored(x, "marts")
    measured = {
        "gold_daily_revenue": "returning_customers", "gold_product_performance": "repeat_purchase_rate",
        "gold_customer_segments": "predicted_next_purchase_days", "gold_inventory_health": "stock_change_30days",
        "gold_campaign_roi": "conversion_rate",
    }
    together = None
    for table, mart in full_marts(tables, AS_OF).items():
        tables.overwrite(table, mart)
        part = tables.read(table).select(F.lit(table).alias("mart"), F.col(measured[table]).isNotNull().alias("known"))
        together = part if together is None else together.unionAll(part)
    return together.groupBy("mart").agg(F.count("*").alias("n"), F.count(F.when(F.col("known"), 1)).alias("n_known"))


# ---------------------------------------------------------------- the daily run
#
# The four ``refresh_*`` queries read the tables of the same two runs, which the first of them to be called in a session makes: only
# its time is that of the runs.


@query
def refresh_silver_customers(x: Lake) -> DataFrame:
    """Clean customers after two daily runs."""
    return x.two_runs[0].read("silver_customers").select(
        "customer_id", "full_name", "loyalty_tier", "total_lifetime_spend", "is_active", "customer_age_days",
        "customer_segment", "created_at", "updated_at", "source_table",
    )


@query
def refresh_silver_orders(x: Lake) -> DataFrame:
    """Clean orders after two daily runs."""
    return x.two_runs[0].read("silver_orders").select(*schemas.column_names("silver_orders"))


@query
def refresh_price_history(x: Lake) -> DataFrame:
    """The price history after two daily runs."""
    return x.two_runs[0].read("product_price_history").select(*x.price_history.columns)


@query
def refresh_counts(x: Lake) -> DataFrame:
    """What the two runs report: rows stored, inserted, rejected and changed."""
    shown = [
        "bronze_customers_inserted", "bronze_orders", "silver_customers", "silver_customers_rejected", "silver_orders",
        "silver_orders_inserted", "silver_orders_rejected", "product_price_history_new", "product_price_history_updated",
        "product_price_history_unchanged",
    ]
    rows = [(run, name, counts.get(name, 0)) for run, counts in x.two_runs[1].items() for name in shown]
    return x.spark.createDataFrame(rows, "run_id string, name string, n long")


# ---------------------------------------------------------------- streams


@query
def orders_incremental(x: Lake) -> DataFrame:
    """The order feed as a file stream, merged batch by batch into an order table."""
    root = scratch_path(x.spark, "ingest")
    lines = x.spark.readStream.schema(star.SOURCES["lineitem"]).option("pathGlobFilter", "lineitem*.parquet").parquet(x.sf)
    orders = KeyedTable(x.spark, f"{root}/orders", ["order_id"])
    ingest.ingest_stream(
        lines, orders, f"{root}/checkpoint", star.order_arrival(),
        shape=lambda batch: star.order_feed(x.spark, x.sf, lines=batch),
    ).awaitTermination()
    return orders.read().select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount", "discount_amount",
        "final_amount", "status", "promo_code",
    )


@query
def customers_incremental(x: Lake) -> DataFrame:
    """A later customer delivery streamed into the stored customers."""
    root = scratch_path(x.spark, "customers")
    batch = star.customer_batch(x.spark, x.sf)
    batch.write.parquet(f"{root}/inbox")
    stored = MergedTable(x.spark, f"{root}/table", ["customer_id"], bronze.CUSTOMER_UPDATES, "last_modified_date")
    stored.start(x.customers)
    stream = ingest.stream_feed(x.spark, f"{root}/inbox", batch.schema)
    ingest.upsert_stream(stream, stored, f"{root}/checkpoint", ["arrival"], star.midnight(AS_OF)).awaitTermination()
    return stored.merged().select(
        "customer_id", "first_name", "last_name", "email", "signup_date", "loyalty_tier", "total_lifetime_spend",
        "is_active",
    )


@query
def stream_daily_revenue(x: Lake) -> DataFrame:
    """Daily revenue from a stream of clean orders, every day current."""
    root = scratch_path(x.spark, "revenue")
    x.clean_orders.write.parquet(f"{root}/orders")
    stream = x.spark.readStream.schema(schemas.struct_type("silver_orders")).parquet(f"{root}/orders")
    return revenue.run_daily_revenue(x.spark, stream, root)


@lru_cache(maxsize=8)
def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """One set of (unevaluated) table plans per session and folder."""
    return Lake(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: publish(fn(lake(spark, sf_dir)))

    return {name: bind(fn) for name, fn in QUERIES.items()}

