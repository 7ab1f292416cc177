"""Key merges without a transactional table format."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.latest import latest_per_key


def insert_ignore(
    target: DataFrame | None, batch: DataFrame, key: list[str], order: list[Column]
) -> DataFrame:
    """Rows of ``batch`` to append: the first per key that ``target`` does not hold yet.

    Only the key columns of the target are read; whether the batch or the target moves
    is Spark's choice by the sizes it finds at run time.
    """
    first = latest_per_key(batch, key, order)
    if target is None:
        return first
    return first.join(target.select(*key), key, "left_anti")


def fold_batch(batch: DataFrame, key: list[str], update_cols: list[str], order: list[str]) -> DataFrame:
    """One row per key as if the rows had been merged one by one in ``order``.

    Updated columns take the last row, all others the first. The aggregates
    combine on the map side, so a key repeated many times stays cheap.
    """
    kept = [c for c in batch.columns if c not in key and c not in update_cols]
    at = F.struct(*order)
    folded = batch.groupBy(*key).agg(
        F.min_by(F.struct(*(kept or key)), at).alias("_first"),
        F.max_by(F.struct(*(update_cols or key)), at).alias("_last"),
    )
    return folded.select(
        *key, *[F.col(f"_first.{c}").alias(c) for c in kept], *[F.col(f"_last.{c}").alias(c) for c in update_cols]
    )


def merge_subset(
    target: DataFrame,
    batch: DataFrame,
    key: list[str],
    update_cols: list[str],
    order: list[str],
    touch_col: str | None = None,
    touched_at: dt.datetime | None = None,
) -> DataFrame:
    """Upsert that overwrites only ``update_cols`` of a matched row.

    The batch is folded to one row per key in the arrival order of the columns ``order``
    first. Unmatched target rows stay, unmatched batch rows are added whole, nothing is deleted.
    """
    source = fold_batch(batch, key, update_cols, order)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_batch", F.lit(True)).alias("s")
    matched = F.col("t._in_target") & F.col("s._in_batch")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in key]

    def merged(name: str, dtype) -> Column:
        if name in key:
            value = F.coalesce(f"t.{name}", f"s.{name}")
        elif name == touch_col:
            value = F.when(matched, F.lit(touched_at)).otherwise(F.col(f"t.{name}"))
        elif name not in source.columns:
            value = F.col(f"t.{name}")
        elif name in update_cols:
            value = F.when(F.col("s._in_batch"), F.col(f"s.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            value = F.when(F.col("t._in_target"), F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
        return value.cast(dtype).alias(name)

    return t.join(s, on, "full").select(*[merged(f.name, f.dataType) for f in target.schema.fields])
