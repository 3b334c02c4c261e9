"""Loan-level panel risk analytics as Spark DataFrame operators."""

from arrearscope.config import RiskConfig

__all__ = ["RiskConfig"]
