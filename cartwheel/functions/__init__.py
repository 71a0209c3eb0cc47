"""Column-level helpers: pure ``Column -> Column`` expressions, JVM-side."""

from cartwheel.functions.columns import (
    STAGE_BY_EVENT_TYPE,
    bucket_label,
    bucket_start,
    cart_product,
    funnel_stage,
    pct,
    purchase_flag,
    ratio2,
)
from cartwheel.functions.codec import (
    JSON_TS_FORMAT,
    decode_json_or_raw,
    encode_json,
    value_text,
)

__all__ = [
    "STAGE_BY_EVENT_TYPE", "funnel_stage", "purchase_flag", "cart_product", "pct", "ratio2",
    "bucket_start", "bucket_label", "JSON_TS_FORMAT", "encode_json", "value_text",
    "decode_json_or_raw",
]
