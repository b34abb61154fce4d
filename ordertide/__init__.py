"""ordertide: order-event processing on Spark DataFrames and Structured Streaming.

Every public operator takes and returns a DataFrame; nothing is collected on
the driver. See README.md for the operator map.
"""

from ordertide.config import Limits, REFERENCE_LIMITS, TABLE_LIMITS

__all__ = ["Limits", "REFERENCE_LIMITS", "TABLE_LIMITS"]
