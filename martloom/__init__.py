"""Conformed-mart analytics on Spark: raw incident text in, dimensions, facts and marts out."""
