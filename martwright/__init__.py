"""Audit-grade curated marts on Spark.

Dated file extracts are landed, conformed to typed staging tables, turned into a
star schema with slowly changing dimensions, checked, and published only when every
check passes. Each step is a function from DataFrames to a DataFrame; only
``plans.daily`` and ``sources`` run jobs.
"""
