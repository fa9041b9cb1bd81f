"""Operators that prepare training data: documents in, documents or decisions out."""
