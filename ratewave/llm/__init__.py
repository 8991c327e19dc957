"""Operators of a training-data pipeline over whole text corpora.

Every operator takes DataFrames and column names, selects only the columns it
needs under names of its own (so further columns of the input cannot clash)
and returns a DataFrame.  ``queries`` registers one query per operator.
"""
