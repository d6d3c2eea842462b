"""Operators that prepare text corpora for training: each takes and returns DataFrames."""
