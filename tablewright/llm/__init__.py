"""Operators that prepare text corpora for training language models.

One module per operator. Each states what it does with nulls, empty and very long
texts, ties, repeated rows, empty tables and clashing column names. ``suite`` has the
registered queries and their SQL; nothing else in the library imports this package.
"""
