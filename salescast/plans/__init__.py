"""Operator chains: the feature table, the five stages, the run and its summary."""
