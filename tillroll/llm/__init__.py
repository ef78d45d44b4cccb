"""Operators for preparing training data (text, pages, embeddings).

Nothing outside this subpackage imports it.
"""
