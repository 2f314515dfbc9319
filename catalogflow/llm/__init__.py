"""Operators that prepare text for the training of language models.

Each module holds one operator; ``queries`` applies them to the given tables. Nothing outside
this folder imports it.
"""
