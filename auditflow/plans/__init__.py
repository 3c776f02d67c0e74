"""Queries assembled from the operators, with their SQL counterparts."""
