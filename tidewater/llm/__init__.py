"""Operators of a training-data pipeline over text tables.

One module per operator, ``queries`` registers their ``opN_<name>`` queries and
SQL.  Nothing else in the library imports this subpackage.
"""
