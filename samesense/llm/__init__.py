"""Operators of a training-data pipeline over whole text tables.

One module per operator, named queries in ``queries``. Nothing outside this folder
imports it; it uses the general helpers ``skew`` and ``storage`` of the package.
"""
