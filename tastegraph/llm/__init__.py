"""Operators for preparing training text at scale.

Every module is one operator over DataFrames; `queries` registers them.
"""
