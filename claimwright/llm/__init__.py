"""Operators for preparing training data for language models.

Every operator takes DataFrames and returns DataFrames; the thin queries in
:mod:`claimwright.llm.queries` apply them to the test tables.  Nothing outside
this package imports it.
"""
