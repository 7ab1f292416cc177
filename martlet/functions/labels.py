"""Business labels and scores as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names, limits, codes and texts that results must reproduce.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
ORDER_STATUSES = ("completed", "pending", "cancelled", "refunded")
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")
PROMO_PERCENT = {"SAVE10": 10, "FLASH20": 20, "NEW50": 50, "WEEK15": 15}
PRICE_TIERS = ("Budget", "Mid-range", "Premium")
BUDGET_BELOW, MID_RANGE_UP_TO = 50, 200
FULL_QUALITY = 100
QUALITY_PENALTIES = {"title": 20, "description": 20, "image_url": 10, "rating_rate": 10}
NEW_BELOW_DAYS, VIP_ABOVE_SPEND, LOYAL_ABOVE_DAYS, CHURNED_ABOVE_DAYS = 30, 50000, 365, 180
STOCK_STATUSES = ("Out of Stock", "Low Stock", "Overstock", "In Stock")
OVERSTOCK_TIMES_REORDER = 5
NEVER_ORDERED_DAYS = 9999
CHURN_ABOVE_DAYS = {"High": 180, "Medium": 90}
RATING_ABOVE_ROI = {"Excellent": 200, "Good": 100, "Average": 0}
INITIAL_RECORD = "Initial record"


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def price_tier(price: Column) -> Column:
    budget, middle, premium = PRICE_TIERS
    known = F.when(price < BUDGET_BELOW, budget).when(price <= MID_RANGE_UP_TO, middle)
    return known.when(price.isNotNull(), premium)


def quality_score(title: Column, description: Column, image: Column, rating: Column) -> Column:
    """100 minus a penalty per missing field; a zero rating counts as missing."""
    missing = {
        "title": _blank(title),
        "description": _blank(description),
        "image_url": _blank(image),
        "rating_rate": rating.isNull() | (rating == 0),
    }
    score = F.lit(FULL_QUALITY)
    for field, absent in missing.items():
        score = score - F.when(absent, QUALITY_PENALTIES[field]).otherwise(0)
    return score.cast("int")


def valid_email(email: Column) -> Column:
    """``(?d)``: as a line end, ``$`` accepts a newline and nothing else."""
    return email.rlike(f"(?d){EMAIL_PATTERN}")


def full_name(first: Column, last: Column) -> Column:
    """First and last name joined without outer white space; a missing part is left out."""
    return F.btrim(F.concat_ws(" ", first, last), F.lit(" \t\n\r\x0b\x0c"))


def lifecycle_segment(age_days: Column, spend: Column, is_active: Column) -> Column:
    """A NULL activity flag counts as inactive."""
    inactive = ~F.coalesce(is_active, F.lit(False))
    return (
        F.when(inactive & (age_days > CHURNED_ABOVE_DAYS), "Churned")
        .when(age_days < NEW_BELOW_DAYS, "New")
        .when(spend > VIP_ABOVE_SPEND, "VIP")
        .when(age_days > LOYAL_ABOVE_DAYS, "Loyal")
        .otherwise("Regular")
    )


def stock_status(stock: Column, reorder_point: Column) -> Column:
    empty, low, over, normal = STOCK_STATUSES
    plenty = stock > reorder_point * OVERSTOCK_TIMES_REORDER
    return F.when(stock == 0, empty).when(stock < reorder_point, low).when(plenty, over).otherwise(normal)


def _first_above(value: Column, limits: dict[str, int], otherwise: str) -> Column:
    """Label of the first limit the value exceeds; NULL exceeds none."""
    return F.coalesce(*[F.when(value > limit, name) for name, limit in limits.items()], F.lit(otherwise))


def churn_risk(days_since_last: Column) -> Column:
    return _first_above(days_since_last, CHURN_ABOVE_DAYS, "Low")


def performance_rating(roi: Column) -> Column:
    return _first_above(roi, RATING_ABOVE_ROI, "Poor")


def campaign_status(end_date: Column, as_of: Column) -> Column:
    return F.when(end_date >= as_of, "Active").otherwise("Completed")


def rfm_segment(r: Column, f: Column, m: Column, n_orders: Column) -> Column:
    """First matching rule wins."""
    rules = [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 3) & (f >= 3) & (m >= 3), "Loyal Customers"),
        ((r >= 4) & (f <= 2), "Potential Loyalists"),
        ((r <= 2) & (f >= 3), "At Risk"),
        ((r <= 2) & (f <= 2), "Lost"),
        (n_orders == 0, "New (No Orders)"),
    ]
    return F.coalesce(*[F.when(hit, F.lit(name)) for hit, name in rules], F.lit("Regular"))


def price_change_reason(old_price: Column, price: Column, old_tier: Column, tier: Column) -> Column:
    def arrow(what, old, new, sign):
        shown = [F.coalesce(c.cast("string"), F.lit("None")) for c in (old, new)]
        text = F.concat(F.lit(f"{what} change: {sign}"), shown[0], F.lit(f" → {sign}"), shown[1])
        return F.when(~old.eqNullSafe(new), text)

    return F.concat_ws("; ", arrow("Price", old_price, price, "₹"), arrow("Tier", old_tier, tier, ""))


def tier_change_reason(old_tier: Column, tier: Column, old_spend: Column, spend: Column) -> Column:
    """One wording for moves in either direction."""
    def shown(c):
        return F.coalesce(c.cast("string"), F.lit("None"))

    return F.concat(
        F.lit("Tier upgrade: "), shown(old_tier), F.lit(" → "), shown(tier),
        F.lit(" (LTV: ₹"), shown(old_spend), F.lit(" → ₹"), shown(spend), F.lit(")"),
    )
