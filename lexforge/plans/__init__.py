"""Queries over the driver's tables, and the composite jobs."""
