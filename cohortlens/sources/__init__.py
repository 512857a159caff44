"""Readers, sinks and driver-table adapters."""

from .tables import read_table
from .adapters import (
    order_events, mortality_from_customers, event_stream_events,
    raw_lab_text, graph_patients, order_label_strings, EVENT_CLASSES,
)

__all__ = [
    "read_table", "order_events", "mortality_from_customers", "event_stream_events",
    "raw_lab_text", "graph_patients", "order_label_strings", "EVENT_CLASSES",
]
