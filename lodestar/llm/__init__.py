"""Operators for preparing training data at scale (documents, pages, vectors).

Each module holds one operator with its own interface; ``queries.py`` derives
the registered digest queries from them.
"""
