"""Operators for large text corpora: each module is one operator; ``queries`` applies them to the benchmark tables."""
