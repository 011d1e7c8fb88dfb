"""Operators for training-data pipelines over text tables.

Every module holds one operator with a general interface, its registered query
``opN_<name>`` (a thin projection of the operator's output) and, where SQL can
express it, the equivalent SQL.  Nothing outside this subpackage imports it.
"""
