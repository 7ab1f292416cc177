"""Type 2 history: one row per key and validity period."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.dates import OPEN_END, day
from martlet.functions.labels import INITIAL_RECORD
from martlet.session import stored

PERIOD = ["valid_from", "valid_to", "is_current", "change_reason"]


def _open() -> Column:
    """A row whose flag is unknown is a closed one."""
    return F.coalesce(F.col("is_current"), F.lit(False))


def _compare(history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Current history rows beside the snapshot, with the action each key needs."""
    old = history.filter(_open()).withColumn("_was", F.lit(True)).alias("old")
    new = snapshot.withColumn("_is", F.lit(True)).alias("new")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    action = (
        F.when(F.col("_was").isNull(), "new")
        .when(F.col("_is").isNull(), "missing")
        .when(differs, "updated")
        .otherwise("unchanged")
    )
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full").withColumn("_action", action)


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    key: str,
    tracked: list[str],
    carried: list[str],
    as_of: dt.date,
    reason: Callable[[str, str], Column],
    surrogate: str | None = None,
    at: dt.datetime | None = None,
) -> DataFrame:
    """The history after ``snapshot`` was seen on ``as_of``.

    A key without a current row starts one. A change of a ``tracked`` column
    (NULL equals NULL) closes the current row the day before and starts another;
    ``carried`` columns are recorded but trigger nothing. Keys absent from the
    snapshot stay open. ``reason(old, new)`` receives the two alias prefixes.

    With ``at``, rows carry ``created_at`` and ``updated_at``: a row is created when it opens and
    updated when it closes.

    Closed rows pass through untouched; the open ones and the snapshot meet in a
    single full join that emits one or two rows per key.
    """
    attributes = [key, *carried]
    compared = _compare(history, snapshot, key, tracked)

    now = F.lit(at).cast("timestamp_ntz")
    audit = ["created_at", "updated_at"] if at else []

    def row(side: str, valid_from, valid_to, current, why, changed: bool) -> Column:
        created = now if side == "new" else F.col("old.created_at") if audit else None
        updated = now if changed else F.col("old.updated_at") if audit else None
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in attributes],
            valid_from.alias("valid_from"), valid_to.alias("valid_to"),
            F.lit(current).alias("is_current"), why.alias("change_reason"),
            *[c.alias(n) for n, c in zip(audit, (created, updated))],
        )

    action = F.col("_action")
    opened = row(
        "new", day(as_of), day(OPEN_END), True, F.when(action == "new", INITIAL_RECORD).otherwise(reason("old", "new")), True
    )
    kept = row("old", F.col("old.valid_from"), F.col("old.valid_to"), True, F.col("old.change_reason"), False)
    closed = row(
        "old", F.col("old.valid_from"), day(as_of - dt.timedelta(days=1)), False, F.col("old.change_reason"), True
    )
    rows = (
        F.when(action == "new", F.array(opened))
        .when(action == "updated", F.array(closed, opened))
        .otherwise(F.array(kept))
    )
    columns = [*attributes, *PERIOD, *audit]
    result = (
        history.filter(~_open()).select(*columns).unionByName(compared.select(F.inline(rows)))
    )
    if surrogate:
        result = result.withColumn(surrogate, F.xxhash64(key, "valid_from"))
    return result


def scd2_changes(history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """``(action, n)`` for the keys of the snapshot: new, updated or unchanged."""
    compared = _compare(history, snapshot, key, tracked).filter("_action <> 'missing'")
    return compared.groupBy(F.col("_action").alias("action")).agg(F.count("*").alias("n"))


def scd2_as_of(history: DataFrame, fact: DataFrame, key: str, at: str, how: str = "left") -> DataFrame:
    """Each fact row with the history row valid on its ``at`` date, by sorting both together.

    Versions and facts are one table in ranges of (key, time), versions first; a fact takes the last version before it
    in its range, or, where its range has none, the last one of the ranges before, of which there is one row for each range and key.
    So a row is made for each fact and version and none for their pairs, however many versions a key has, and a
    frequent key takes several ranges. Empty periods (changed twice on a day) are valid on no day; of periods that overlap
    the one that began last counts. Facts without a key or date have no version.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    carried = [c for c in history.columns if c != key]
    versions = history.filter(F.col(key).isNotNull() & (F.col("valid_from") <= F.col("valid_to"))).select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_at"),
        F.struct(*carried).alias("_version"),
        F.lit(None).cast(fact.schema).alias("_fact"),
    )
    facts = fact.select(
        F.col(key).alias("_key"),
        F.col(at).cast("date").alias("_at"),
        F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"),
        F.struct(*fact.columns).alias("_fact"),
    )
    dated = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    events = versions.unionByName(facts).withColumn("_after", F.col("_fact").isNotNull())
    placed = stored(
        events.repartitionByRange("_key", "_at", "_after", F.xxhash64("_fact")).withColumn("_range", F.spark_partition_id()), "as-of"
    )
    ranged = placed.filter(dated)
    before = Window.partitionBy("_range", "_key").orderBy("_at", "_after").rowsBetween(Window.unboundedPreceding, 0)
    own = ranged.withColumn("_own", F.last("_version", ignorenulls=True).over(before)).filter("_after")
    last = ranged.groupBy("_range", "_key").agg(F.max_by("_version", F.when(~F.col("_after"), F.col("_at"))).alias("_last"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select(
        F.col("_range").alias("_in"), F.col("_key").alias("_of"), F.last("_last", ignorenulls=True).over(earlier).alias("_handed")
    ).filter("_handed is not null")
    found = own.join(handed, (F.col("_range") == F.col("_in")) & (F.col("_key") == F.col("_of")), "left")
    version = F.coalesce("_own", "_handed")
    valid = F.when(F.col("_at") <= version["valid_to"], version)
    matched = found.select("_fact", valid.alias("_version")).select("_fact.*", *[F.col("_version")[c].alias(c) for c in carried])
    if how == "inner":
        return matched.filter(F.col("valid_from").isNotNull())
    kinds = {f.name: f.dataType for f in history.schema.fields}
    undated = placed.filter(~dated).select("_fact.*")
    return matched.unionByName(undated.withColumns({c: F.lit(None).cast(kinds[c]) for c in carried}))
