"""Queries over the driver tables and their SQL twins (used by ``__spark_entry__``)."""
