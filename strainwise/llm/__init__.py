"""Operators for preparing training data from large text corpora.  Nothing else in the library imports this package."""
