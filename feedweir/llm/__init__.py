"""Operators that prepare documents for the training of language models."""
