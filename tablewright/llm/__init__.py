"""Operators that prepare text for training large language models."""
