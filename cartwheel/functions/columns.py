"""Scalar expressions shared by batch and streaming transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original application's funnel definition:
# event type -> funnel stage; any other type is stage 0.
STAGE_BY_EVENT_TYPE = {
    "search": 1,
    "page_view": 1,
    "product_view": 2,
    "add_to_cart": 3,
    "purchase": 4,
}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_map(column: str, mapping: dict, default: str) -> Column:
    """``CASE column WHEN k THEN v ... ELSE default END`` as one expression
    (one parse instead of one JVM call per branch)."""
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)
    branches = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return F.expr(f"CASE `{column}` {branches} ELSE {default} END")


def funnel_stage(event_type: str = "event_type") -> Column:
    """Stage of one event (int); unknown or null types are stage 0."""
    return case_map(event_type, STAGE_BY_EVENT_TYPE, "0").cast("int")


def purchase_flag(event_type: Column | str = "event_type") -> Column:
    """1 for a purchase, else 0 (int, as the original flag column)."""
    return F.when(_c(event_type) == "purchase", F.lit(1)).otherwise(F.lit(0))


def cart_product(event_type: Column | str = "event_type",
                 product_id: Column | str = "product_id") -> Column:
    """Product id of an add-to-cart event, null otherwise (aggregates skip it)."""
    return F.when(_c(event_type) == "add_to_cart", _c(product_id))


def pct(num: Column | str, den: Column | str) -> Column:
    """(num / den) * 100 rounded to 2 dp; null when den is 0 or null."""
    return F.round(F.try_divide(_c(num).cast("double"), _c(den)) * F.lit(100.0), 2)


def ratio2(num: Column | str, den: Column | str) -> Column:
    """num / den rounded to 2 dp; 0.0 when den is 0 or null (no data)."""
    return F.coalesce(F.round(F.try_divide(_c(num).cast("double"), _c(den)), 2), F.lit(0.0))


def bucket_start(amount: Column | str, width: int) -> Column:
    """Lower bound of the spend bucket: floor(amount / width) * width, bigint."""
    return F.floor(_c(amount) / F.lit(width)) * F.lit(width)


def bucket_label(start: Column | str, end: Column | str) -> Column:
    """"<start>-<end>" label of a spend bucket."""
    return F.concat(_c(start).cast("string"), F.lit("-"), _c(end).cast("string"))
