"""Vital-sign streams and daily lab files as Spark jobs.

Every operator is a function from DataFrame to DataFrame, so batch and
streaming jobs share one set of rules.
"""
