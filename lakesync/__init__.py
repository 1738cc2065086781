"""lakesync: keep analytical copies of operational tables correct and current, on Spark."""

from lakesync.spec import HighWaterMark, TableSpec

__all__ = ["HighWaterMark", "TableSpec"]
