"""Operators for preparing training corpora: dedup, filters, tokens, mixing and extraction.

Nothing outside this subpackage imports it. `queries.QUERIES` and `queries.ORACLE_SQL`
hold the registered queries.
"""
