"""Joins on intervals and calendar neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def interval_join(
    fact: DataFrame,
    dim: DataFrame,
    eq: str,
    point: str,
    start: str,
    end: str,
    how: str = "inner",
    step: str = "month",
    key: str | None = None,
) -> DataFrame:
    """``dim`` joined to the ``fact`` rows whose date lies in its closed interval.

    Every interval is spelled out in pieces of the calendar, so the match is an equi-join on (``eq``, piece) and a popular
    ``eq`` value spreads over the calendar; no range join and no broadcast to size.

    ``step='dyadic'``: the interval as blocks of 1, 2, 4, ... days, at most two of each size, so some 40 rows even for an open end in
    9999. A fact has one key for each size that occurs, which are listed on the driver (23 at most), and meets each interval once: good for
    facts that are few, such as sums by day, and intervals of any length. ``step='month'``: its days, and where it is longer than
    ``DAYS_ALONE`` days the whole months between; a fact has one key, two if such an interval occurs, and an open end in 9999 is 96,000
    rows: good for facts that are many. ``step='day'``: its days, for intervals known to be short. A fact meets only what it matches.
    ``how='left'`` also keeps each dim row without a match, once; it needs the dim's
    unique ``key``. Empty intervals and those with a NULL bound match nothing.
    """
    if step not in ("day", "month", "dyadic"):
        raise ValueError(f"unknown step {step!r}")
    if how not in ("inner", "left") or (how == "left" and key is None):
        raise ValueError("how must be 'inner', or 'left' with the key of the dim")
    facts = fact.withColumnRenamed(eq, "_eq")
    matched = {"day": _daily, "month": _monthly, "dyadic": _dyadic}[step](facts, dim, eq, point, start, end)
    if how == "inner":
        return matched
    found = matched.select(key, *[c for c in fact.columns if c != eq])
    return dim.join(found, key, "left")


def _daily(facts: DataFrame, dim: DataFrame, eq: str, point: str, start: str, end: str) -> DataFrame:
    days = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start), F.col(end)))
    spelled = dim.withColumn("_piece", F.explode(days))
    on = (F.col(eq) == F.col("_eq")) & (F.col("_piece") == F.col("_at"))
    return spelled.join(facts.withColumn("_at", F.col(point)), on).drop("_eq", "_piece", "_at")


#: Days before 1970 that have a number, and sizes of blocks: 2 ** 22 days, some 11,000 years.
_BEFORE, _SIZES = 1 << 21, 23


def _day_number(c: Column) -> Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date")) + F.lit(_BEFORE)


def dyadic_blocks(start: Column, end: Column) -> Column:
    """The closed interval of days as an array of (size, block): days ``block * 2 ** size`` and on."""
    first, after, blocks = _day_number(start), _day_number(end) + 1, []
    for size in range(_SIZES):
        low, high = F.shiftright(first + F.lit((1 << size) - 1), size), F.shiftright(after, size)
        for odd, block in ((low, low), (high, high - 1)):
            taken = (low < high) & (odd % 2 == 1)
            blocks.append(F.when(taken, F.struct(F.lit(size).alias("size"), block.alias("block"))))
    return F.when(start <= end, F.array_compact(F.array(*blocks)))


def _dyadic(facts: DataFrame, dim: DataFrame, eq: str, point: str, start: str, end: str) -> DataFrame:
    spelled = dim.withColumn("_piece", F.explode(dyadic_blocks(F.col(start), F.col(end))))
    sizes = sorted(r[0] for r in spelled.select("_piece.size").distinct().collect())
    keys = [F.struct(F.lit(s).alias("size"), F.shiftright(_day_number(F.col(point)), s).alias("block")) for s in sizes]
    keyed = facts.withColumn("_at", F.explode(F.array(*keys) if keys else F.lit(None).cast("array<struct<size: int, block: int>>")))
    on = (F.col(eq) == F.col("_eq")) & (F.col("_piece.size") == F.col("_at.size")) & (F.col("_piece.block") == F.col("_at.block"))
    return spelled.join(keyed, on).drop("_eq", "_piece", "_at")


#: Days up to which an interval is spelled by days alone. Longer ones hold two whole months at least.
DAYS_ALONE = 92


def calendar_pieces(start: Column, end: Column) -> Column:
    """The closed interval as an array of numbers: those of days, and of the whole months in it if it is long."""
    month, after = F.date_add(F.last_day(F.date_sub(start, 1)), 1), F.trunc(F.date_add(end, 1), "month")
    days = F.concat(
        F.when(start < month, F.sequence(start, F.date_sub(month, 1))).otherwise(F.array().cast("array<date>")),
        F.when(after <= end, F.sequence(after, end)).otherwise(F.array().cast("array<date>")),
    )
    months = F.sequence(month, F.add_months(after, -1), F.expr("INTERVAL 1 MONTH"))
    pieces = F.concat(F.transform(days, _day_piece), F.transform(months, _month_piece))
    return F.when(_is_long(start, end), pieces).when(start <= end, F.transform(F.sequence(start, end), _day_piece))


def _is_long(start: Column, end: Column) -> Column:
    return F.datediff(end, start) >= DAYS_ALONE


def _day_piece(day: Column) -> Column:
    return _day_number(day) * 2


def _month_piece(day: Column) -> Column:
    return _day_number(F.trunc(day, "month")) * 2 + 1


def _monthly(facts: DataFrame, dim: DataFrame, eq: str, point: str, start: str, end: str) -> DataFrame:
    spelled = dim.withColumn("_piece", F.explode(calendar_pieces(F.col(start), F.col(end))))
    first, last = _day_number(F.col(start)), _day_number(F.col(end))
    reach = dim.filter(F.col(start) <= F.col(end)).agg(F.max(_is_long(F.col(start), F.col(end))), F.min(first), F.max(last)).first()
    # Facts on days of no interval match nothing and need not move; where no interval holds a day, these are all.
    facts = facts.filter(F.lit(False) if reach[0] is None else _day_number(F.col(point)).between(reach[1], reach[2]))
    day, month = _day_piece(F.col(point)), _month_piece(F.col(point))
    keyed = facts.withColumn("_at", F.explode(F.array(day, month)) if reach[0] else day)
    # Pairs are the load, not bytes: as many tasks as the session has, since partitions joined by size would hold too many keys.
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = keyed.filter("_eq IS NOT NULL AND _at IS NOT NULL").repartition(tasks, "_eq", "_at")
    on = (F.col(eq) == F.col("_eq")) & (F.col("_piece") == F.col("_at"))
    # The right side is the one kept in memory for a key, and read again for each row of the left.
    return keyed.join(spelled, on).select(*[spelled[c] for c in dim.columns], *[keyed[c] for c in facts.columns if c != "_eq"])


def vs_previous_day(df: DataFrame, date_col: str, value_col: str) -> DataFrame:
    """Add ``previous_value`` from the previous *calendar* day; a gap gives NULL.

    ``df`` holds one row per day. Each row is sent to its own day and to the next
    one, so one exchange of the small daily table replaces a self-join.
    """
    others = [c for c in df.columns if c != date_col]
    shifted = df.select(
        F.inline(
            F.array(
                F.struct(F.col(date_col).alias("_day"), F.lit(True).alias("_own"), F.struct(*others).alias("_row")),
                F.struct(F.date_add(date_col, 1).alias("_day"), F.lit(False).alias("_own"), F.struct(*others).alias("_row")),
            )
        )
    )
    own = F.when(F.col("_own"), F.col("_row"))
    before = F.when(~F.col("_own"), F.col(f"_row.{value_col}"))
    paired = shifted.groupBy(F.col("_day").alias(date_col)).agg(
        F.max(own).alias("_row"), F.max("_own").alias("_own"), F.max(before).alias("previous_value")
    )
    return paired.filter("_own").select(date_col, *[F.col(f"_row.{c}").alias(c) for c in others], "previous_value")
