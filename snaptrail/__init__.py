"""Analytics over histories of periodic snapshots, as PySpark DataFrame operators."""

from snaptrail.layout import CATEGORY_MAP_SCHEMA, HISTORY_SCHEMA, Layout

__all__ = ["CATEGORY_MAP_SCHEMA", "HISTORY_SCHEMA", "Layout"]
