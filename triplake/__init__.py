"""Layered trip-record analytics on Spark: raw files to a fact table and KPIs."""

from triplake.config import Settings

__all__ = ["Settings"]
