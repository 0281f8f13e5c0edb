"""Composed runs and their settings."""

from .cleaning import Result, metrics_record, plan, run
from .config import CleaningConfig, rule_from

__all__ = ["CleaningConfig", "Result", "metrics_record", "plan", "rule_from", "run"]
