"""Merchant card transactions on Spark: Bronze, Silver, Gold, checks and reports."""
