"""Clickstream analytics on Spark: the same DataFrame code for tables and streams."""

from clickloom.config import Settings

__all__ = ["Settings"]
