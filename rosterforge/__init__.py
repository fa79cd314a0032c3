"""Spark jobs that turn licence registers into clean provider listings.

Every job is a function from DataFrames to DataFrames; reading, writing and
calling outside services are separate steps chosen by the caller.
"""

__version__ = "0.1.0"
