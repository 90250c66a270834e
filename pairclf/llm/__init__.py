"""Operators for large text corpora: one module each, thin queries in ``queries``."""
