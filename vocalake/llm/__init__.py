"""Operators that large training-data pipelines need, one module each; nothing else in the package imports them."""
