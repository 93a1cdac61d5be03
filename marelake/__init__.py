"""Change-data lakehouse on Spark: raw change events in, star schema out.

Sub-packages
------------
``functions``  Column -> Column library (standardizing, scalar, date helpers).
``sources``    readers for raw change topics and for file listings.
``operators``  DataFrame -> DataFrame building blocks (dedup, upsert, history...).
``plans``      table specs, layer runs, context / dimension / fact models.
``streaming``  the same operators under Structured Streaming.
"""
