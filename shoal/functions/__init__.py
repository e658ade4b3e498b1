"""Scalar functions, all of them built-in column expressions."""
