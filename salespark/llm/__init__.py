"""Operators for large-scale training-data pipelines (see README, "Corpus operators")."""
