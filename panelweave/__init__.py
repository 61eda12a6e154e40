"""Data-preparation and analytics operators for long panel tables on Spark.

Every operator takes and returns lazy ``DataFrame`` objects, so Catalyst sees
one plan per query.
"""
