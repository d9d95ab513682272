"""Queries of the driver contract: the package's operators on the given tables."""
