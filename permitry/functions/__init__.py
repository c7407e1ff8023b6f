"""Scalar column functions, all built from Spark expressions."""
