"""Retail analytics on Spark: receipt-grain recipes over DataFrames."""
