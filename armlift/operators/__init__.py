"""Experiment operators.  Each takes and returns DataFrames keyed by ``experiment_id``."""
