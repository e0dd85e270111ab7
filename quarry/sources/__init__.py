"""Sources and sinks: landing-area reader, driver-table overlay, bronze views."""

from quarry.sources import bronze, overlay, parquet

__all__ = ["bronze", "overlay", "parquet"]
