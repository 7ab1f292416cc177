"""Typed feed readers, lineage and raw payload columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet import schemas

LINEAGE = ["source", "ingestion_timestamp", "pipeline_run_id"]


def feed_schema(name: str) -> T.StructType:
    """Record layout of a feed: the bronze table without lineage columns."""
    if name == "products":
        return T.StructType.fromDDL(schemas.PRODUCT_FEED)
    if name == "users":
        return T.StructType.fromDDL(schemas.USER_FEED)
    stamped = {*LINEAGE, "raw_json", "last_modified_date", "inventory_id", "source_filename"}
    return T.StructType([f for f in schemas.struct_type(f"bronze_{name}").fields if f.name not in stamped])


def read_feed(
    spark: SparkSession, name: str, path: str, fmt: str = "parquet", filename_col: str | None = None, **options
) -> DataFrame:
    """Read a feed with its declared schema; a missing or empty feed is an error.

    JSON is one record per line, which splits over tasks; pass ``multiLine=True`` for
    a feed that arrives as one array. CSV has a header.
    """
    defaults = {"header": "true"} if fmt == "csv" else {}
    reader = spark.read.schema(feed_schema(name)).format(fmt)
    df = reader.options(**{**defaults, **options}).load(path)
    if df.isEmpty():
        raise ValueError(f"feed {name!r} at {path} has no records")
    return with_filename(df, filename_col) if filename_col else df


def split_feed(
    spark: SparkSession, name: str, path: str, fmt: str = "json", **options
) -> tuple[DataFrame, DataFrame]:
    """The records of a text feed (JSON lines or CSV), and the lines that are none.

    A line that is cut off, has too few or too many fields, or a value that is not of its type would become a record with NULLs.
    It is rescued instead: ``source_filename``, the ``line`` as received, and ``parsed``, what could be read of it, as JSON.
    A feed without a sound record is an error, as in ``read_feed``.
    """
    declared = feed_schema(name)
    defaults = {"header": "true"} if fmt == "csv" else {}
    reader = spark.read.schema(declared.add("_rescued", "string")).format(fmt)
    found = reader.options(**{**defaults, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_rescued"}).load(path)
    fields = [f.name for f in feed_schema(name).fields]
    # A reader that needs few fields parses only those and would not see what is wrong with the others, so all are asked for.
    parsed = F.to_json(F.struct(*fields))
    records = found.filter(F.col("_rescued").isNull() & parsed.isNotNull()).select(*fields)
    if records.isEmpty():
        raise ValueError(f"feed {name!r} at {path} has no records")
    rescued = found.filter(F.col("_rescued").isNotNull() & parsed.isNotNull()).select(
        F.col("_metadata.file_path").alias("source_filename"), F.col("_rescued").alias("line"), parsed.alias("parsed")
    )
    return records, rescued


def rescued_rejects(rescued: DataFrame, name: str) -> DataFrame:
    """Rescued lines as rows of ``rejected_records``: the line is the key."""
    return rescued.select(
        F.lit(f"bronze_{name}").alias("table_name"), F.col("line").alias("record_key"), F.array(F.lit("malformed_record")).alias("reasons")
    )


def with_filename(df: DataFrame, out: str = "source_filename") -> DataFrame:
    return df.withColumn(out, F.col("_metadata.file_path"))


def parse_iso(df: DataFrame, dates: list[str] = (), timestamps: list[str] = ()) -> DataFrame:
    """ISO strings to DATE / TIMESTAMP; an unparsable text gives NULL for the gate to reject."""
    typed: dict[str, Column] = {c: F.col(c).try_cast("date") for c in dates}
    typed |= {c: F.col(c).try_cast("timestamp_ntz") for c in timestamps}
    return df.withColumns(typed)


def with_raw_json(df: DataFrame, out: str = "raw_json", record: list[str] | None = None) -> DataFrame:
    """Keep the record as received in one JSON string. ``record``: its columns, if there are others by now."""
    return df.withColumn(out, F.to_json(F.struct(*(record or ["*"]))))


def flatten_products(df: DataFrame) -> DataFrame:
    """Product feed record to bronze columns; absent optional fields stay NULL."""
    extra = [c for c in df.columns if c not in feed_schema("products").fieldNames()]
    return df.select(
        F.col("id").cast("int").alias("product_id"),
        "title",
        "price",
        "description",
        "category",
        F.col("image").alias("image_url"),
        F.col("rating.rate").alias("rating_rate"),
        F.col("rating.count").alias("rating_count"),
        *extra,
    )


def with_lineage(df: DataFrame, source: str, run_id: str, ingested_at: dt.datetime | Column) -> DataFrame:
    at = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    return df.withColumns(
        {
            "source": F.lit(source),
            "ingestion_timestamp": at.cast("timestamp_ntz"),
            "pipeline_run_id": F.lit(run_id),
        }
    )


def product_lookup(products: DataFrame, product_id: int) -> DataFrame:
    return products.filter(F.col("product_id") == F.lit(product_id))


def product_categories(products: DataFrame) -> DataFrame:
    return products.select("category").distinct()
