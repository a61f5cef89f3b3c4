"""Inputs, queries and their SQL counterparts used to check the package on the given tables."""
