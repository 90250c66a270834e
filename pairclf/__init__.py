"""Pairwise and one-against-the-rest classification of labelled vectors on Spark."""

__version__ = "0.1.0"
