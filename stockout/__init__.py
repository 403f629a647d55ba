"""Sold-out detection and uncensored-demand estimation for retail broadcasts, on Spark.

The library is a set of DataFrame -> DataFrame functions. One run covers any number of
broadcast days and both channels at once: ``broad_dt`` and the channel are ordinary key
columns, so a single day, a month backfill and years of history are the same plan.
"""

__all__ = ["session", "schemas"]
