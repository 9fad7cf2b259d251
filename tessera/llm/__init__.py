"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general DataFrame interface; ``queries`` derives the registered
``opN_*`` queries from them.
"""
