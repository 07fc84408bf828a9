"""Relational operators over documents, units, dictionaries and evaluations; each takes and returns DataFrames."""
