"""Product and category summaries (A4, A5).

Purchases are summed by product before the catalogue is joined: the join sees
one row per product, and the copies of a hot product combine map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.events import enrich_with_products


def product_summary(purchases: DataFrame, products: DataFrame) -> DataFrame:
    """A4: purchases and revenue (2 dp) of every sold catalogue product."""
    sold = purchases.where("product_id is not null").groupBy("product_id").agg(
        F.count("event_id").alias("num_purchases"), F.count("*").alias("units"))
    return enrich_with_products(sold, products).select(
        "product_id", "name", "category", "num_purchases",
        F.round(F.col("units") * F.col("cost"), 2).alias("revenue"))


def _totals(level: DataFrame, keys: list[str], **more) -> DataFrame:
    return level.groupBy(*keys).agg(
        *[c.alias(name) for name, c in more.items()],
        F.sum("num_purchases").alias("num_purchases"), F.round(F.sum("revenue"), 2).alias("revenue"))


def category_summary(products: DataFrame) -> DataFrame:
    """A5: products, purchases and revenue per category, rolled up from the
    product level. ``num_products`` is not additive across batches (D9)."""
    return _totals(products, ["category"], num_products=F.count("product_id"))


def summary_totals(batches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Product and category totals over the product summaries written per
    batch. Categories are rolled up from the product totals, as a product
    that is sold in several batches counts once."""
    whole = _totals(batches, ["product_id", "name", "category"])
    return whole, category_summary(whole)
