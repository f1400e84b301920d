"""Retail sales lake on Spark: landing, daily star schema, running totals, star queries."""
