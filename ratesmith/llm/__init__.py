"""Operators that prepare text corpora for training, and the queries that apply them."""
