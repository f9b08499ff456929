"""Operators that prepare text and vector corpora for model training."""
