"""Operators for preparing training data at scale: ten methods, their queries and their SQL.

Nothing outside this package imports it; the package may use the general helpers of the library.
"""
