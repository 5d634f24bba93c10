"""Batch engine for digital-marketing spend data, built on Spark DataFrames.

Raw JSON-lines ad exports become a clean table partitioned by day; the clean table, joined
with country, exchange-rate and channel lookups, becomes a fact table with spend in USD.
"""
