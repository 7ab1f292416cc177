"""Bounded samples of labelled rows, on which the classifiers are fitted."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bound on the bytes of labelled texts of each class that a model is fitted on.
BYTES_PER_CLASS = 32 << 20


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a missing id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def labelled_texts(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    usable: Column,
    per_class: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    bytes_per_class: int = BYTES_PER_CLASS,
) -> tuple[pa.Array, list[int], list[int]]:
    """Texts, classes and ids of at most ``per_class`` ids of each class, the first in the order of a hash of the id.

    Only labels decide the sample, so documents are read once, against at most ``2 * per_class`` ids. Of an id that several rows
    carry, the text with the smallest hash counts. Of the texts of a class, in the same order, those that ``bytes_per_class`` has
    room for are taken, each whole. So what reaches the driver is bounded in rows and in bytes.
    """
    pool = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & F.col("label").isin(0, 1)
    )
    pool = pool.filter(usable).distinct().withColumn("order", F.xxhash64("id"))
    sample = None
    for value in (0, 1):
        part = pool.filter(F.col("label") == value).orderBy("order", "id").limit(per_class)
        sample = part if sample is None else sample.unionByName(part)
    texts = docs.select(F.col(id_col).alias("of"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(sample), F.col("of") == F.col("id"))  # at most 2 * per_class rows
    one = rows.groupBy("id", "label", "order").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    # At most per_class rows of a class.
    upto = Window.partitionBy("label").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, 0)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    fitting = one.withColumn("bytes", F.sum(size).over(upto)).filter(F.col("bytes") <= bytes_per_class)
    found = sorted(fitting.select("id", "label", "text").collect(), key=lambda r: (r["id"], r["label"]))
    return pa.array([r["text"] for r in found], pa.large_string()), [r["label"] for r in found], [r["id"] for r in found]
