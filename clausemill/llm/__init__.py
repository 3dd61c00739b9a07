"""Operators that prepare training data for language models, and their queries."""
