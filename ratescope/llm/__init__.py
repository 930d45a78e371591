"""Operators for building training corpora, and the pipeline that chains five of them."""
