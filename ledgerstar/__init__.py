"""Retail sales warehouse on Spark: landed text parts to star schema to reports."""

from ledgerstar.plans.star import Star

__all__ = ["Star"]
