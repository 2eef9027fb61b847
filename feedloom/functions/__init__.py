"""Column expressions (JVM side, inside whole-stage codegen; no Python UDFs)."""

from feedloom.functions.text import item_text, join_text, normalise_ws, WS_CLASS
from feedloom.functions.time import event_time_from_ms, iso_utc_from_ms, utc_date
from feedloom.functions.predicates import falsy

__all__ = [
    "WS_CLASS", "normalise_ws", "join_text", "item_text",
    "event_time_from_ms", "iso_utc_from_ms", "utc_date",
    "falsy",
]
