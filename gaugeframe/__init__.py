"""Indicator analytics on Spark: select, collect, clean, average and pivot indicator data."""
