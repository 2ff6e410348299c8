"""Operators of a training-data pipeline, one module each.

Nothing outside this package imports it; its queries are in ``registry``.
Every operator reads the columns it needs by name and returns only its own
columns (or, for filters, the rows it was given), so extra or clashing
column names in the input do not matter.
"""
