"""Batch operators.  Each takes and returns DataFrames and starts no job unless its docstring says so."""
