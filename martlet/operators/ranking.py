"""Whole-table and per-group ranks that never move all rows of a group into one task.

A window without a partition (or with a partition that may hold a third of all
rows) sorts in a single task. Here, whatever the size:

1. only the sort columns and the key are range-partitioned and sorted; the key splits
   frequent values, and the place of a row in its range needs no window,
2. that order is pinned by a checkpoint, and one count per range gives the offsets (a
   broadcast of one row per range, so its size is the shuffle partition count),
3. the rank of a value is the smallest place that holds it less the smallest place of its
   group: two aggregations with map-side minima,
4. the rows, pinned before all this, so that they are computed once, meet these minima in a join whose row side can be
   split where a value is frequent.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.functions.ordering import SortKey
from martlet.session import pin

#: ``monotonically_increasing_id`` keeps the place in a partition below this bit.
_RANGE_BIT = 33


def _sorted_ranges(df: DataFrame, sort: list[Column]) -> DataFrame:
    """``df`` in sorted ranges, pinned, with ``_id``: the range number above the place in it."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    return pin(ranges.withColumn("_id", F.monotonically_increasing_id()))


def _range_sizes(pinned: DataFrame) -> list[tuple[int, int]]:
    """(range, rows) in order: one row per range."""
    return sorted(tuple(r) for r in pinned.groupBy(F.shiftright("_id", _RANGE_BIT)).count().collect())


def _placed(pinned: DataFrame) -> DataFrame:
    """``_place``: the number of rows before a row in the whole order."""
    offsets, before = [], 0
    for number, n in _range_sizes(pinned):
        offsets.append((number, before))
        before += n
    ranges = pinned.sparkSession.createDataFrame(offsets, "_range long, _before long")
    within = F.col("_id").bitwiseAND(F.lit((1 << _RANGE_BIT) - 1))
    joined = pinned.withColumn("_range", F.shiftright("_id", _RANGE_BIT)).join(F.broadcast(ranges), "_range")
    return joined.withColumn("_place", F.col("_before") + within).drop("_range", "_before", "_id")


def placed_rows(df: DataFrame, sort: list[Column]) -> DataFrame:
    """``df`` with ``_place``, the number of rows before a row under ``sort``, from 0 without gaps; the order is pinned."""
    return _placed(_sorted_ranges(df, sort))


class Rank(NamedTuple):
    """SQL ``RANK()`` of ``order`` per ``by`` group (whole table if empty), as column ``out``: ties equal, gaps kept."""

    by: list[str]
    order: SortKey
    out: str


def _ranks(pinned: DataFrame, rank: Rank, key: str) -> tuple[DataFrame, list[Column]]:
    """One row for each value of a group with its rank, and how rows of ``pinned`` find it."""
    by, order = rank.by, rank.order
    sort = [*[F.col(b).asc_nulls_last() for b in by], order.column(), F.col(key).asc_nulls_last()]
    names = [*by, order.name]
    v, g = ([f"_{rank.out}_{kind}{i}" for i in range(len(names))] for kind in ("v", "g"))
    placed = _placed(_sorted_ranges(pinned.select(*dict.fromkeys([*names, key])), sort))
    values = placed.groupBy(*[F.col(c).alias(n) for c, n in zip(names, v)]).agg(F.min("_place").alias("_first"))
    if by:
        groups = values.groupBy(*[F.col(x).alias(y) for x, y in zip(v[:-1], g)]).agg(F.min("_first").alias("_start"))
        values = values.join(groups, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(v[:-1], g)])
    else:
        values = values.withColumn("_start", F.lit(0))
    ranks = values.select(*v, (F.col("_first") - F.col("_start") + 1).cast("int").alias(rank.out))
    return ranks, [F.col(c).eqNullSafe(F.col(x)) for c, x in zip(names, v)]


def with_ranks(df: DataFrame, ranks: list[Rank], key: str) -> DataFrame:
    """``df`` with a column for each of ``ranks``. ``df`` is computed once, whatever their number, and pinned."""
    pinned = pin(df)
    joined, names = pinned, list(df.columns)
    for rank in ranks:
        values, same = _ranks(pinned, rank, key)
        names.append(rank.out)
        joined = joined.join(values, same, "left").select(*names)
    return joined


def rank_within(df: DataFrame, by: list[str], order: SortKey, key: str, out: str) -> DataFrame:
    return with_ranks(df, [Rank(by, order, out)], key)


def global_rank(df: DataFrame, order: SortKey, key: str, out: str) -> DataFrame:
    return with_ranks(df, [Rank([], order, out)], key)


def global_ntile(df: DataFrame, k: int, order: SortKey, key: str, out: str) -> DataFrame:
    """SQL ``NTILE(k)`` over the whole table, ties broken by ``key``.

    Sorts only (order column, key), looks up the last row of each tile - at most
    ``k - 1`` rows - and labels the full rows by comparing them with those, which needs
    no exchange of the full rows at all. Those are computed once and pinned.
    """
    df = pin(df)
    return df.withColumn(out, tile_of(order, key, tile_ends(df, k, order, key)))


def tile_ends(df: DataFrame, k: int, order: SortKey, key: str) -> list[tuple]:
    """The (value, key) pairs of the last rows of tiles ``1 .. k-1``."""
    pinned = _sorted_ranges(df.select(order.name, key), [order.column(), F.col(key).asc_nulls_last()])
    sizes = _range_sizes(pinned)
    total = sum(n for _, n in sizes)
    base, rest = divmod(total, k)
    wanted, seen = [], 0
    ends = [tile * base + min(tile, rest) for tile in range(1, k)]
    for number, n in sizes:
        wanted += [(number << _RANGE_BIT) + end - seen - 1 for end in ends if seen < end <= seen + n]
        seen += n
    rows = pinned.filter(F.col("_id").isin(wanted)).collect() if wanted else []
    found = {row["_id"]: (row[order.name], row[key]) for row in rows}
    return [found[i] for i in wanted]


def tile_of(order: SortKey, key: str, ends: list[tuple]) -> Column:
    tile = F.lit(1)
    for value, last_key in ends:
        past = order.after(value) | (order.same(value) & SortKey(key).after(last_key))
        tile = tile + F.when(past, 1).otherwise(0)
    return tile.cast("int")
