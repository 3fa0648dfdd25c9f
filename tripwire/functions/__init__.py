from tripwire.functions.columns import (
    as_ntz,
    event_time,
    is_json_object,
    missing_fields,
    nan_to_null,
    watermark_safe,
)

__all__ = ["as_ntz", "event_time", "is_json_object", "missing_fields", "nan_to_null", "watermark_safe"]
