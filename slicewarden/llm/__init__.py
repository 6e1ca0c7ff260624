"""Operators for training-data pipelines over documents and web pages.

Each module holds one operator with its own interface; ``queries`` registers
one query ``opN_<name>`` per operator.  Nothing outside this package imports it.
"""
