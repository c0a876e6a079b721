"""Retail point-of-sale analytics on Spark: feeds, star schema, reports, checks."""
