"""Operators for preparing large text corpora (one module per operator).

Nothing else in the library imports this subpackage.  Each module holds a general
DataFrame -> DataFrame interface; :mod:`sessionrate.llm.queries` registers the thin
per-table queries and :mod:`sessionrate.llm.oracle` their SQL where SQL can express them.
"""
