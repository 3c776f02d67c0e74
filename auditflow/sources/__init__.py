"""Inputs: raw message streams, the area dimension, and views over the given tables."""
