"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Each module holds one operator with its own general
interface; ``queries.py`` derives the registered ``opN_*`` queries from them.
"""
