"""Registered queries and, next to each, the SQL that checks it.

Every module offers ``QUERIES`` (name to a function of session and data folder)
and ``ORACLE`` (name to SQL over the same tables). Test tables are clean, so the
cleaning queries first spoil their columns, with text that both engines run.
"""
