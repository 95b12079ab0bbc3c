"""Operators for preparing training text at scale.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; :mod:`navspark.llm.queries` holds the
thin registered queries and their SQL.
"""
