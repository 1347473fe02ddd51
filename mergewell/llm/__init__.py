"""Operators that prepare text, pages, vectors and conversations for training language models."""
