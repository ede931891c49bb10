"""Operators for building language-model training corpora (one module each)."""
