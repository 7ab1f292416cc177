"""Table declarations: columns, keys, length limits and value checks.

One compact spec per table; Spark schemas and quality rules are generated from
it, so a column is stated once. ``string(n)`` carries a length limit, ``!`` marks
a required column.
"""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.labels import ORDER_STATUSES


class Table(NamedTuple):
    layer: str
    key: tuple[str, ...]
    columns: str
    defaults: dict = {}
    unique: tuple[str, ...] = ()
    partition: str | None = None
    #: Columns that rows are sorted by inside a file, so that a reader of few of their values skips most pages.
    cluster: tuple[str, ...] = ()


# Column names, types, limits and defaults of the data model.
TABLES: dict[str, Table] = {
    "bronze_products": Table("bronze", ("product_id", "ingestion_timestamp"), """
        product_id int!, title string(500), price decimal(10,2), description string, category string(100),
        image_url string, rating_rate decimal(3,2), rating_count int, source string(50),
        ingestion_timestamp timestamp_ntz!, pipeline_run_id string(100), raw_json string"""),
    "bronze_orders": Table("bronze", ("order_id",), """
        order_id string(50)!, customer_id string(50), product_id int, quantity int, unit_price decimal(10,2),
        total_amount decimal(10,2), discount_amount decimal(10,2), final_amount decimal(10,2),
        order_timestamp timestamp_ntz, status string(20), payment_method string(50), promo_code string(20),
        shipping_address string, source string(50), ingestion_timestamp timestamp_ntz,
        pipeline_run_id string(100), raw_json string"""),
    "bronze_customers": Table("bronze", ("customer_id",), """
        customer_id string(50)!, first_name string(100), last_name string(100), email string(255), phone string(20),
        street_address string(255), city string(100), state string(100), postal_code string(20), country string(50),
        signup_date date, loyalty_tier string(20), total_lifetime_spend decimal(12,2), is_active boolean,
        source string(50), ingestion_timestamp timestamp_ntz, pipeline_run_id string(100),
        last_modified_date timestamp_ntz""", {"country": "India", "is_active": True}),
    "bronze_inventory": Table("bronze", ("inventory_id",), """
        inventory_id bigint!, product_id int, stock_quantity int, warehouse_location string(100), reorder_point int,
        reorder_quantity int, cost_price decimal(10,2), supplier_name string(255), last_restock_date date,
        inventory_date date, source string(50), ingestion_timestamp timestamp_ntz, pipeline_run_id string(100),
        source_filename string(255)"""),
    "bronze_campaigns": Table("bronze", ("campaign_id",), """
        campaign_id string(50)!, campaign_name string(255), channel string(100), promo_code string(20),
        discount_percentage int, start_date date, end_date date, budget decimal(12,2), actual_spend decimal(12,2),
        source string(50), ingestion_timestamp timestamp_ntz, pipeline_run_id string(100)"""),
    "silver_products": Table("silver", ("product_id",), """
        product_id int!, product_name string(500)!, price decimal(10,2)!, description string, category string(100)!,
        image_url string, average_rating decimal(3,2), review_count int, price_tier string(20), is_active boolean,
        data_quality_score int""", {"is_active": True}),
    "silver_orders": Table("silver", ("order_id",), """
        order_id string(50)!, customer_id string(50)!, product_id int!, quantity int!, unit_price decimal(10,2)!,
        total_amount decimal(10,2)!, discount_amount decimal(10,2), final_amount decimal(10,2), order_date date!,
        order_time string!, order_timestamp timestamp_ntz!, status string(20)!, payment_method string(50),
        promo_code string(20), order_hour int, order_day_of_week string(10), is_weekend boolean,
        is_discounted boolean""", {"discount_amount": 0}, partition="order_month", cluster=("product_id", "customer_id")),
    "silver_customers": Table("silver", ("customer_id",), """
        customer_id string(50)!, full_name string(255)!, email string(255)!, phone string(20), city string(100),
        state string(100), country string(50), signup_date date!, loyalty_tier string(20),
        total_lifetime_spend decimal(12,2), is_active boolean, customer_age_days int, customer_segment string(50)""",
        {"country": "India", "loyalty_tier": "Bronze", "total_lifetime_spend": 0, "is_active": True}, ("email",)),
    "silver_inventory": Table("silver", ("product_id",), """
        product_id int!, stock_quantity int!, warehouse_location string(100), reorder_point int!,
        cost_price decimal(10,2), stock_status string(20), days_until_stockout int, inventory_value decimal(12,2),
        inventory_date date!"""),
    "silver_campaigns": Table("silver", ("campaign_id",), """
        campaign_id string(50)!, campaign_name string(255), channel string(100), promo_code string(20),
        discount_percentage int, start_date date, end_date date, budget decimal(12,2), actual_spend decimal(12,2),
        is_active boolean"""),
    "gold_daily_revenue": Table("gold", ("revenue_date",), """
        revenue_date date!, year int, month int, quarter int, day_of_week string(10), is_weekend boolean,
        total_revenue decimal(15,2), total_orders bigint, total_items_sold bigint, average_order_value decimal(15,2),
        completed_orders bigint, pending_orders bigint, cancelled_orders bigint, cancellation_rate decimal(15,2),
        unique_customers bigint, new_customers bigint, returning_customers bigint,
        total_discount_given decimal(15,2), orders_with_promo bigint, promo_usage_rate decimal(15,2),
        revenue_vs_previous_day decimal(15,2), revenue_growth_pct decimal(15,2)"""),
    "gold_product_performance": Table("gold", ("product_id", "analysis_period", "period_start_date"), """
        product_id int!, analysis_period string(20)!, period_start_date date!, period_end_date date,
        product_name string(500), category string(100), current_price decimal(10,2), units_sold bigint,
        total_revenue decimal(15,2), total_profit decimal(15,2), profit_margin decimal(15,2), category_rank int,
        overall_rank int, avg_stock_level int, stockout_days bigint, inventory_turnover decimal(15,2),
        unique_customers bigint, repeat_purchase_rate decimal(15,2), average_rating decimal(3,2),
        revenue_growth_vs_previous decimal(15,2)"""),
    "gold_customer_segments": Table("gold", ("customer_id",), """
        customer_id string(50)!, full_name string(255), email string(255), signup_date date, recency_score int,
        frequency_score int, monetary_score int, rfm_combined_score string(10), days_since_last_order int,
        total_orders bigint, total_lifetime_value decimal(15,2), average_order_value decimal(15,2),
        customer_segment string(50), segment_description string, churn_risk string(20),
        predicted_next_purchase_days int, recommended_action string, first_order_date date, last_order_date date"""),
    "gold_inventory_health": Table("gold", ("product_id", "snapshot_date"), """
        snapshot_date date!, product_id int!, product_name string(500), category string(100), current_stock int,
        stock_status string(20), warehouse_location string(100), inventory_value decimal(12,2),
        cost_price decimal(10,2), selling_price decimal(10,2), potential_profit decimal(15,2),
        avg_daily_sales decimal(15,2), days_of_inventory_remaining int, inventory_turnover_rate decimal(15,2),
        is_low_stock boolean, is_overstock boolean, is_dead_stock boolean, reorder_recommended boolean,
        recommended_reorder_quantity int, stock_change_7days int, stock_change_30days int"""),
    "gold_campaign_roi": Table("gold", ("campaign_id",), """
        campaign_id string(50)!, campaign_name string(255), channel string(100), promo_code string(20),
        start_date date, end_date date, budget decimal(12,2), actual_spend decimal(12,2), total_orders bigint,
        total_revenue decimal(15,2), total_profit decimal(15,2), roi decimal(15,2), roas decimal(15,2),
        cost_per_order decimal(15,2), cost_per_acquisition decimal(15,2), new_customers_acquired bigint,
        promo_code_usage_count bigint, conversion_rate decimal(15,2), campaign_rank int, campaign_status string(20),
        performance_rating string(20)"""),
    "order_cells": Table("lattice", ("order_date", "customer_id", "product_id", "promo_code"), """
        order_date date, customer_id string(50), product_id int, promo_code string(20),
        n_orders bigint, n_completed bigint, n_pending bigint, n_cancelled bigint, n_coded bigint, n_valued bigint,
        items bigint, units bigint, revenue decimal(20,2), listed decimal(31,2), discount decimal(20,2),
        first_timestamp timestamp_ntz, first_order_id string(50)""", partition="order_month", cluster=("product_id", "customer_id")),
    "customer_days": Table("lattice", ("order_date", "customer_id"), """
        order_date date, customer_id string(50), promo_code string(20),
        n_orders bigint, n_completed bigint, n_pending bigint, n_cancelled bigint, n_coded bigint, n_valued bigint,
        items bigint, units bigint, revenue decimal(20,2), listed decimal(31,2), discount decimal(20,2),
        first_timestamp timestamp_ntz, first_order_id string(50)""", partition="order_month"),
    "product_days": Table("lattice", ("order_date", "product_id", "promo_code"), """
        order_date date, product_id int, promo_code string(20),
        n_orders bigint, n_completed bigint, n_pending bigint, n_cancelled bigint, n_coded bigint, n_valued bigint,
        items bigint, units bigint, revenue decimal(20,2), listed decimal(31,2), discount decimal(20,2),
        first_timestamp timestamp_ntz, first_order_id string(50)""", partition="order_month"),
    "pending_orders": Table("quarantine", ("order_id",), """
        order_id string(50)!, customer_id string(50), product_id int, quantity int, unit_price decimal(10,2),
        total_amount decimal(10,2), discount_amount decimal(10,2), final_amount decimal(10,2),
        order_timestamp timestamp_ntz, status string(20), payment_method string(50), promo_code string(20)"""),
    "product_winners": Table("state", ("product_id",), """
        product_id int, title string(500), price decimal(10,2), description string, category string(100),
        image_url string, rating_rate decimal(3,2), rating_count int, ingestion_timestamp timestamp_ntz"""),
    "inventory_winners": Table("state", ("product_id",), """
        inventory_id bigint, product_id int, stock_quantity int, warehouse_location string(100), reorder_point int,
        reorder_quantity int, cost_price decimal(10,2), inventory_date date, ingestion_timestamp timestamp_ntz"""),
    "rejected_records": Table("quarantine", ("table_name", "record_key"), """
        table_name string!, record_key string, reasons array<string>"""),
    "product_price_history": Table("history", ("product_id", "valid_from"), """
        price_history_id bigint!, product_id int!, product_name string(500), category string(100),
        price decimal(10,2)!, price_tier string(20), valid_from date!, valid_to date!, is_current boolean,
        change_reason string(255)""", partition="closed_month"),
    "customer_tier_history": Table("history", ("customer_id", "valid_from"), """
        tier_history_id bigint!, customer_id string(50)!, full_name string(255), email string(255),
        loyalty_tier string(20)!, total_lifetime_spend decimal(12,2), valid_from date!, valid_to date!,
        is_current boolean, change_reason string(255)""", partition="closed_month"),
}

# Columns that tell when and from what a stored row was made. The run stamps them.
AUDIT = {
    "silver": {"created_at": "timestamp_ntz", "updated_at": "timestamp_ntz", "source_table": "string"},
    "gold": {"calculated_at": "timestamp_ntz"},
    "history": {"created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
}

# Feed records before lineage columns are added.
PRODUCT_FEED = (
    "id int, title string, price decimal(10,2), description string, category string, image string, "
    "rating struct<rate: decimal(3,2), count: int>"
)
USER_FEED = (
    "id int, email string, username string, name struct<firstname: string, lastname: string>, phone string, "
    "address struct<city: string, street: string, number: int, zipcode: string>"
)

_COLUMN = re.compile(r"(\w+)\s+(\w+(?:\([\d,]+\)|<\w+>)?)(!?)\s*(?:,\s*|$)")


class ColumnSpec(NamedTuple):
    name: str
    type: str
    required: bool
    max_length: int | None


@lru_cache(maxsize=None)
def column_specs(table: str) -> tuple[ColumnSpec, ...]:
    specs = []
    for name, kind, bang in _COLUMN.findall(TABLES[table].columns.strip()):
        limit = re.fullmatch(r"string\((\d+)\)", kind)
        specs.append(ColumnSpec(name, "string" if limit else kind, bool(bang), int(limit[1]) if limit else None))
    return tuple(specs)


def struct_type(table: str) -> T.StructType:
    """Explicit schema of a table; readers never infer."""
    return T.StructType.fromDDL(", ".join(f"{c.name} {c.type}" for c in column_specs(table)))


def audit_columns(table: str) -> dict[str, str]:
    return AUDIT.get(TABLES[table].layer, {})


def stored_type(table: str) -> T.StructType:
    """The schema of a stored table: the declared columns, then those the run stamps."""
    schema = struct_type(table)
    for name, kind in audit_columns(table).items():
        schema = schema.add(name, kind)
    return schema


def stamped(df, table: str, at):
    """``df`` with the audit columns of a new row where it has none; ``at`` is the time of the run."""
    values = {"source_table": F.lit(table.replace("silver", "bronze"))}
    held = {n: F.col(n) if n in df.columns else F.lit(None) for n in audit_columns(table)}
    return df.withColumns(
        {n: F.coalesce(held[n].cast(kind), values.get(n, F.lit(at)).cast(kind)) for n, kind in audit_columns(table).items()}
    )


def column_names(table: str) -> list[str]:
    return [c.name for c in column_specs(table)]


def value_checks(table: str) -> dict[str, Column]:
    """The check constraints of a table. A NULL passes where the column may be NULL."""
    checks = {
        "silver_products": {"price_positive": F.col("price") > 0},
        "silver_orders": {
            "quantity_positive": F.col("quantity") > 0,
            "unit_price_positive": F.col("unit_price") > 0,
            "status_allowed": F.col("status").isin(*ORDER_STATUSES),
        },
        "silver_inventory": {
            "stock_not_negative": F.col("stock_quantity") >= 0,
            "cost_positive": F.col("cost_price").isNull() | (F.col("cost_price") > 0),
        },
    }
    return checks.get(table, {})


def schema_rules(table: str, columns: list[str] | None = None) -> dict[str, Column]:
    """Required, length and check rules of a table, restricted to ``columns`` if given."""
    rules: dict[str, Column] = {}
    for spec in column_specs(table):
        if columns is not None and spec.name not in columns:
            continue
        if spec.required:
            rules[f"{spec.name}_required"] = F.col(spec.name).isNotNull()
        if spec.max_length:
            rules[f"{spec.name}_too_long"] = F.coalesce(F.length(spec.name) <= spec.max_length, F.lit(True))
    return rules | value_checks(table)


def with_defaults(df, table: str):
    """Fill declared defaults for columns the feed does not have at all.

    A column that is present keeps its NULLs.
    """
    types = {c.name: c.type for c in column_specs(table)}
    absent = {n: F.lit(v).cast(types[n]) for n, v in TABLES[table].defaults.items() if n not in df.columns}
    return df.withColumns(absent) if absent else df
