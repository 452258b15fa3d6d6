"""Layered cleaning, star-schema and data-quality jobs written for Spark.

Raw customer, account and transaction records become three layers:

* bronze  - the records as delivered, plus load metadata
* silver  - renamed, typed, standardised, one row per key
* gold    - two dimensions and one fact with stable hashed keys

Everything is a plan over DataFrames. Nothing here creates a session, changes
session settings or pulls data to the driver.
"""
