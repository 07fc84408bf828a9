"""Scalar functions over columns: characters, readings, numbers, costs and mark-up."""
