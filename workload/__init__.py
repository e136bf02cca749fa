"""Queries over the driver tables: lending-shaped views, Spark queries and their SQL twins."""
