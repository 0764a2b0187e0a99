"""Operators for training corpora and the pipeline's building blocks. Nothing else in the library imports this folder."""
