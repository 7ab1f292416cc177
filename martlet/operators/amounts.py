"""Order amounts from price, quantity and promotion code."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_amounts(df: DataFrame, price: str, qty: str, promo: str, percent: dict[str, int]) -> DataFrame:
    """Add ``total_amount``, ``discount_amount`` and ``final_amount``, rounded half up in decimal.

    An amount too large for its type becomes NULL, which the order gate rejects.
    """
    def share(points: int):
        return F.lit(Decimal(points).scaleb(-2)).cast("decimal(3,2)")

    rate = share(0)
    for code, points in percent.items():
        rate = F.when(F.col(promo) == code, share(points)).otherwise(rate)
    exact = "decimal(10,2)"
    return (
        df.withColumn("total_amount", F.round(F.col(price) * F.col(qty), 2).try_cast(exact))
        .withColumn("discount_amount", F.round(F.col("total_amount") * rate, 2).try_cast(exact))
        .withColumn("final_amount", (F.col("total_amount") - F.col("discount_amount")).try_cast(exact))
    )
