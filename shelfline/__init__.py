"""Shelfline: live-commerce analytics on Spark, as DataFrame-to-DataFrame operators."""

__version__ = "0.1.0"
