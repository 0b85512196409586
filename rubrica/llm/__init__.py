"""Operators of a training-data pipeline: archives, filters, near duplicates, classifiers, tokens."""
