"""Per-user behaviour measures: customer value, activity, price sensitivity, shopping gender.

All of them are one aggregation with map-side combine, so a user who owns a large share of the
rows costs one partial row per input split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tagloom.functions import bins
from tagloom.functions.bins import Bins
from tagloom.functions.dates import days_since
from tagloom.operators.joins import lookup_default

# Fixed value: the score of a user none of whose orders had a discount.
NO_DISCOUNT_SCORE = 1e-8
# Fixed value: the share of items that decides a shopping gender.
GENDER_SHARE = 0.6


def rfm_metrics(
    orders: DataFrame, as_of: Column, user: str = "uid", time: str = "finish_time",
    order: str = "order_id", amount: str = "amount", scale: int = 0,
) -> DataFrame:
    """Days since the last order, number of orders, and money spent.

    Amounts are rounded to ``scale`` places before they are summed.
    """
    precision = 10 if scale == 0 else 10 + scale
    return orders.groupBy(user).agg(
        days_since(F.max(time), as_of).alias("recency"),
        F.count(order).alias("frequency"),
        F.sum(F.col(amount).cast(DecimalType(precision, scale))).alias("monetary"),
    )


def rfm_scores(
    metrics: DataFrame, recency: Bins = bins.RFM_RECENCY, frequency: Bins = bins.RFM_FREQUENCY,
    monetary: Bins = bins.RFM_MONETARY, strict: bool = False, user: str = "uid",
) -> DataFrame:
    return metrics.select(
        user,
        recency.score("recency", strict).alias("r_score"),
        frequency.score("frequency", strict).alias("f_score"),
        monetary.score("monetary", strict).alias("m_score"),
    )


def rfe_metrics(
    visits: DataFrame, as_of: Column, moved_back: int = 0, user: str = "uid", time: str = "log_time",
    page: str = "url",
) -> DataFrame:
    """Days since the last visit, page views, and distinct pages.

    Catalyst first aggregates per (user, page), which spreads a very busy user over many tasks.
    """
    return visits.groupBy(user).agg(
        days_since(F.max(time), as_of, moved_back).alias("recency"),
        F.count(page).alias("frequency"),
        F.countDistinct(page).alias("engagements"),
    )


def rfe_scores(
    metrics: DataFrame, recency: Bins = bins.RFE_RECENCY, frequency: Bins = bins.RFE_FREQUENCY,
    engagements: Bins = bins.RFE_ENGAGEMENTS, strict: bool = False, user: str = "uid",
) -> DataFrame:
    return metrics.select(
        user,
        recency.score("recency", strict).alias("r_score"),
        frequency.score("frequency", strict).alias("f_score"),
        engagements.score("engagements", strict).alias("e_score"),
    )


def rfe_bean_scores(metrics: DataFrame, user: str = "uid") -> DataFrame:
    """The six-step variant: three scores and their sum."""
    scored = rfe_scores(
        metrics, bins.BEAN_RECENCY, bins.BEAN_FREQUENCY, bins.BEAN_ENGAGEMENTS, user=user
    )
    return scored.withColumn("score", F.col("r_score") + F.col("f_score") + F.col("e_score"))


def psm_scores(
    orders: DataFrame, user: str = "uid", amount: str = "amount", coupon: str = "coupon",
    mode: str = "whole",
) -> DataFrame:
    """Price sensitivity: share of discounted orders + discount share + relative mean discount.

    ``mode="whole"``: a user without a discounted order scores ``NO_DISCOUNT_SCORE``, and an order
    whose coupon is missing counts as discounted.  ``mode="parts"``: undefined parts count 0, and
    an order whose coupon is missing counts on neither side.
    """
    paid, off = F.col(amount), F.col(coupon)
    if mode == "whole":
        discounted = F.when(off == 0, 0).otherwise(1)
    elif mode == "parts":
        discounted = F.when(off > 0, 1).when(off == 0, 0)
    else:
        raise ValueError(f"mode must be whole or parts, not {mode!r}")
    totals = orders.groupBy(user).agg(
        F.sum(discounted).alias("_dn"),
        F.count(discounted).alias("_n"),
        F.sum(off).cast("double").alias("_d"),
        F.sum(paid + off).cast("double").alias("_r"),
    )
    tdonr = F.try_divide(F.col("_dn"), F.col("_n"))
    tdar = F.try_divide(F.col("_d"), F.col("_r"))
    adar = F.try_divide(
        F.try_divide(F.col("_d"), F.col("_dn")), F.try_divide(F.col("_r"), F.col("_n"))
    )
    parts = totals.select(user, tdonr.alias("tdonr"), tdar.alias("tdar"), adar.alias("adar"))
    if mode == "parts":
        parts = parts.na.fill(0.0, ["tdonr", "tdar", "adar"])
    psm = F.col("tdonr") + F.col("tdar") + F.col("adar")
    return parts.withColumn("psm_score", F.coalesce(psm, F.lit(NO_DISCOUNT_SCORE)))


def weak_label(colour: str, product: str, colours: Sequence[str], products: Sequence[str]) -> Column:
    """1 when the colour or the product type is among those listed, else 0."""
    hit = F.col(colour).isin(*colours) | F.col(product).isin(*products)
    return F.when(hit, 1).otherwise(0)


def usg_features(
    lines: DataFrame, orders: DataFrame, colours: DataFrame, products: DataFrame,
    label_colours: Sequence[str], label_products: Sequence[str], order: str = "order_id",
) -> DataFrame:
    """Order lines as (uid, label, colour id, product id).

    ``lines`` has order, colour and product names; both dimensions have ``id`` and ``name``.
    """
    labelled = lines.select(
        order, "colour", "product",
        weak_label("colour", "product", label_colours, label_products).alias("label"),
    )
    coded = lookup_default(labelled, "colour", colours, "name", "id", "colour_id")
    coded = lookup_default(coded, "product", products, "name", "id", "product_id")
    owned = coded.join(orders.select(order, "uid"), order)
    return owned.select("uid", "label", "colour_id", "product_id")


def gender_by_share(total, male, female, share: float = GENDER_SHARE) -> Column:
    """``"0"`` mostly male items, ``"1"`` mostly female items, ``"-1"`` neither."""
    return (
        F.when(F.try_divide(male, total) >= share, "0")
        .when(F.try_divide(female, total) >= share, "1")
        .otherwise("-1")
    )


def usg_shares(items: DataFrame, user: str = "uid", label: str = "label") -> DataFrame:
    """Items per user, and how many of them carry label 0 and label 1."""
    return items.groupBy(user).agg(
        F.count("*").alias("total"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("male"),
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("female"),
    )
