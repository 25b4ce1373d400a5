"""Column functions: time parts, the timestamp contract, hourly conditions."""

from . import conditions, contract, timecols
from .contract import add_normalised, normalise, reason_counts

__all__ = ["add_normalised", "conditions", "contract", "normalise", "reason_counts", "timecols"]
