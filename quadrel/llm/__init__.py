"""Operators that prepare language-model training data at corpus scale."""
