"""Operators for training-data pipelines over the ``documents`` and ``pages`` tables.

Nothing outside this subpackage imports it.  Each module holds one operator
with its own interface; ``queries`` registers one query per operator.
"""
