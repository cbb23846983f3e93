"""Operators that prepare text for training language models.

Nothing outside this package imports it. Each module holds one operator with its own
interface; ``queries`` applies them to the test tables.
"""
