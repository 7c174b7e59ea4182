"""Operators of a training-data pipeline (near-dedup, filters, extraction,
tokenisation), each in a module of its own; ``queries`` registers them.

Nothing else in the library imports this subpackage.
"""
