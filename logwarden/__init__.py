"""Threat analytics over SSH and sudo/su authentication logs, on Spark DataFrames.

``functions``  column expressions (time, addresses, severity, text)
``sources``    readers and writers
``operators``  DataFrame -> DataFrame steps (parsing, detection, aggregation)
``plans``      batch jobs composed from the operators
``streaming``  the same threat summary, kept up to date by Structured Streaming
"""

__version__ = "0.1.0"
