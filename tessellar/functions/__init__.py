"""Scalar functions as column expressions, with scalar twins where a driver needs them."""
