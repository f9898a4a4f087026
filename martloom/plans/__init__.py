"""Dimension, fact, mart and quality jobs built from the operators."""
