"""Operators that prepare a text corpus for training, and their registered queries."""
