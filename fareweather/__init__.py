"""fareweather: trip records, hourly conditions and zone demand on Spark."""

from .config import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
