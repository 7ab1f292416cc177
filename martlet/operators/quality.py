"""Quality gates: split rows into passed and quarantined, never fail the job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def failed_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks; a rule that evaluates to NULL is broken."""
    return F.array_compact(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    )


def gate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``(passed, quarantined)``; quarantined rows carry ``reasons``.

    The passed side is a plain conjunction, so simple comparisons still reach the
    Parquet scan. A filter drops NULL results, hence both sides are complementary.
    """
    passed = df.filter(reduce(Column.__and__, rules.values()))
    quarantined = df.withColumn("reasons", failed_rules(rules)).filter(F.size("reasons") > 0)
    return passed, quarantined


def require_keys(df: DataFrame, dim: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``on`` value exists in ``dim`` and those whose value does not."""
    keys = dim.select(on)
    return df.join(keys, on, "left_semi"), df.join(keys, on, "left_anti")


def with_known_flag(df: DataFrame, dim: DataFrame, on: str, flag: str) -> DataFrame:
    """Keep every row and tell whether its ``on`` value exists in ``dim``."""
    keys = dim.select(on).filter(F.col(on).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(keys, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def unique_on(df: DataFrame, cols: list[str], keep: str) -> tuple[DataFrame, DataFrame]:
    """Keep the row with the smallest ``keep`` per ``cols``; the rest is quarantined.

    ``keep`` is the row key. The survivors are found by a map-side combined
    aggregate and matched back on that key, so a value shared by a third of all
    rows never gathers in one task, as it would under a window. A NULL equals
    nothing, so rows with a NULL in ``cols`` all pass.
    """
    any_null = reduce(Column.__or__, [F.col(c).isNull() for c in cols])
    own_group = F.when(any_null, F.col(keep)).alias("_own_group")
    survivors = df.groupBy(*cols, own_group).agg(F.min(keep).alias("_keep")).select(F.col("_keep").alias(keep))
    return df.join(survivors, keep, "left_semi"), df.join(survivors, keep, "left_anti")


def ri_coverage(fact: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """One row: distinct fact keys unknown to ``dim``, known ones, and the size of ``dim``."""
    used = fact.select(on).distinct()
    known = dim.select(on).distinct()
    both = used.withColumn("used", F.lit(1)).join(known.withColumn("known", F.lit(1)), on, "full")
    return both.agg(
        F.count(F.when(F.col("known").isNull(), 1)).alias("orphans"),
        F.count(F.when(F.col("known").isNotNull() & F.col("used").isNotNull(), 1)).alias("referenced"),
        F.count("known").alias("total"),
    )
