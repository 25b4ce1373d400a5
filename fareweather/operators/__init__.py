"""Operators: joins, ranks, rules, checks, profiles."""

from . import checks, joins, profile, ranking, rules

__all__ = ["checks", "joins", "profile", "ranking", "rules"]
