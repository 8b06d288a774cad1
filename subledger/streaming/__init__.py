"""Raw orders as a stream."""

from subledger.streaming.retries import first_deliveries, read_deliveries, read_orders, write_orders

__all__ = ["first_deliveries", "read_deliveries", "read_orders", "write_orders"]
