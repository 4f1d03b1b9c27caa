"""Operators for training data: duplicates, runs, percentiles, splits, mixtures, tokens, containers, spam pages."""
