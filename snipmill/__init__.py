"""Preparation of source-code corpora on Spark."""
