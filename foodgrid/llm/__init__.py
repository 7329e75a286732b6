"""Operators for building training corpora (documents -> prepared text).

Nothing outside this subpackage imports it; ``queries.py`` and ``oracle.py``
here hold its registered queries and their SQL.
"""
